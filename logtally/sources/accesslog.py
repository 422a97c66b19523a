"""Raw access logs as a Spark data source: ``format("accesslog")`` and ``USING accesslog``.

:func:`create_log_view` makes a catalog table and a catalog view over it that names the files,
so every session that knows the format can query the files parsed::

    create_log_view(spark, "logs", "/logs/2026-12")
    spark.sql("SELECT status, sum(bytes) FROM logs WHERE ip = '10.0.0.1' GROUP BY status")

(Options of a table do not reach the readers of Python data sources; those of a scan,
``SELECT .. FROM t WITH (files = '..')``, do, and a view keeps them.)

Options: ``files`` (or the path given to ``load``): a file, folder or glob; ``dialect`` and
``onBadBytes`` as in :func:`logtally.operators.parse.parse`; ``splitBytes`` (64 MB): plain files
are read in byte ranges of that size, each line by the range it begins in, ``.gz`` files
whole and ``.gz.gz`` files through both layers; ``pushdown``: take filters into the reader.

With ``pushdown 'true'`` (set by :func:`create_log_view`; the session needs
``spark.sql.python.filterPushdown.enabled``, which :func:`register` sets) equality, lists and
prefixes of ``ip`` and comparisons of ``status`` are tested by the reader. An exact ``ip`` is
first sought in the raw line, so most lines never reach the pattern.

Lines are parsed by Python in the reading tasks, Arrow batch by Arrow batch: the way for
ad-hoc SQL over raw files. The reports parse with built-in functions (``read_lines`` and
``parse``), which is faster, and give the same rows. Files are listed on the driver by
pyarrow's file systems.
"""

from __future__ import annotations

import gzip
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)

from ..functions import patterns as P
from .double_gzip import _arrow_fs, _local, iter_lines

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "accesslog"
SPLIT_BYTES = 1 << 26
BATCH_LINES = 8192
COMPARE = {
    EqualTo: lambda a, b: a == b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
}


def python_pattern(dialect: str) -> re.Pattern:
    """The dialect's pattern for Python's engine: the JVM's ``.`` stops at more line ends, and
    its end of input is written another way."""
    text = P.COMBINED if dialect == "combined" else P.SERDE
    text = re.sub(r"(?<!\\)\.(?=[+*])", "[^\\\\n\\\\r\\\\u0085\\\\u2028\\\\u2029]", text).replace(r"\z", r"\Z")
    return re.compile(text, re.ASCII)


def whole_number(text: str | None, bits: int) -> int | None:
    """``text`` as a signed integer of that many bits, as a cast reads it; None if it is none."""
    text = (text or "").strip(STRIPPED)
    if not re.fullmatch(r"[+-]?[0-9]+", text):
        return None
    value = int(text)
    return value if -(1 << bits - 1) <= value < 1 << bits - 1 else None


# White space and control characters.
STRIPPED = "".join(map(chr, [*range(0x21), *range(0x7F, 0xA0)]))


class LineParser:
    """Lines to rows of the nine fields (None: no row)."""

    def __init__(self, dialect: str, policy: str | None) -> None:
        self.dialect, self.policy = dialect, policy
        self.match = python_pattern(dialect).search

    def typed_bytes(self, raw: str | None):
        if self.policy is None:
            return raw
        value = whole_number(raw, 64)
        if value is None and self.policy == "zero":
            return 0
        if value is None and self.policy == "fail":
            raise ValueError(f"unparsable byte count: {raw if raw is not None else 'NULL'}")
        return value

    def __call__(self, line: str) -> list | None:
        m = self.match(line)
        if self.dialect == "combined":
            if m is None:
                return None
            row = [g or "" for g in m.groups()]
            row[5] = int(row[5])
        else:
            row = list(m.groups()) if m else [None] * 9
        row[6] = self.typed_bytes(row[6])
        return None if self.policy == "drop" and row[6] is None else row


@dataclass
class FilePart(InputPartition):
    path: str
    start: int
    end: int | None  # None: the whole file, decompressed

    def __post_init__(self) -> None:
        self.value = (self.path, self.start)


def files_under(path: str) -> list[tuple[str, int]]:
    """``(path, bytes)`` of the files that a path, folder or glob names; names that begin
    with ``_`` or ``.`` are hidden."""
    from pyarrow import fs

    scheme = path.split("://", 1)[0] + "://" if "://" in path and not path.startswith("file:") else ""
    local = _local(path)
    system, inner = (fs.LocalFileSystem(), local) if local is not None else _arrow_fs(path)
    fixed = re.split(r"[*?\[{]", inner, maxsplit=1)[0]
    if fixed != inner:
        top = fixed.rsplit("/", 1)[0] or "/"
        # ``*`` and ``?`` stay within a name.
        like = re.sub(r"\\\*", "[^/]*", re.sub(r"\\\?", "[^/]", re.escape(inner)))
        found = system.get_file_info(fs.FileSelector(top, recursive=True))
        found = [f for f in found if re.fullmatch(like, f.path) or re.match(like + "/", f.path)]
    else:
        (info,) = system.get_file_info([inner])
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True))
    depth = len(fixed.rsplit("/", 1)[0])
    shown = [f for f in found if f.type == fs.FileType.File and not re.search(r"/[_.]", f.path[depth:])]
    prefix = "" if not scheme or local is not None else scheme
    return sorted((prefix + f.path, f.size) for f in shown)


class RangeStream:
    """The bytes of the lines of an open file that begin in ``[start, end)``."""

    def __init__(self, raw, start: int, end: int) -> None:
        self.raw, self.left, self.ended = raw, end - start, False
        raw.seek(max(0, start - 1))
        if start:  # the line that reaches into the range is another one's
            before = raw.read(1)
            if before != b"\n":
                self._skip()

    def _skip(self) -> None:
        """Read up to the next line end."""
        while chunk := self.raw.read(1 << 16):
            at = chunk.find(b"\n")
            if at >= 0:
                self.raw.seek(at + 1 - len(chunk), 1)
                self.left -= at + 1
                return
            self.left -= len(chunk)
        self.left = 0

    def read(self, n: int) -> bytes:
        if self.ended:
            return b""
        if self.left <= 0:
            self.ended = True
            return b""
        data = self.raw.read(min(n, self.left))
        self.left -= len(data)
        if not data or self.left > 0 or data.endswith(b"\n"):
            self.ended = not data
            return data
        # The last line ends behind the range.
        parts = [data]
        while chunk := self.raw.read(1 << 16):
            at = chunk.find(b"\n")
            parts.append(chunk[: at + 1] if at >= 0 else chunk)
            if at >= 0:
                break
        self.ended = True
        return b"".join(parts)


class AccessLogReader(DataSourceReader):
    def __init__(self, options: dict[str, str], dialect: str, policy: str | None, types: list[pa.DataType]) -> None:
        self.path = options.get("files") or options.get("path")
        if not self.path:
            raise ValueError(f"name the log files in the option 'files', not in {sorted(options)}")
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.dialect, self.policy, self.types = dialect, policy, types
        self.tests: list[tuple[int, str, object]] = []

    def partitions(self) -> list[FilePart]:
        parts = []
        for path, size in files_under(self.path):
            if path.endswith(".gz"):
                parts.append(FilePart(path, 0, None))
            else:
                parts += [FilePart(path, at, min(at + self.split, size)) for at in range(0, size, self.split)]
        return parts or [FilePart("", 0, None)]

    def _lines(self, part: FilePart) -> Iterator[list[str]]:
        if not part.path:
            return
        from pyarrow import fs

        local = _local(part.path)
        system, inner = (fs.LocalFileSystem(), local) if local is not None else _arrow_fs(part.path)
        with system.open_input_file(inner) as raw:
            if part.end is not None:
                yield from iter_lines(RangeStream(raw, part.start, part.end))
                return
            stream = gzip.GzipFile(fileobj=raw)
            yield from iter_lines(gzip.GzipFile(fileobj=stream) if part.path.endswith(".gz.gz") else stream)

    def _wanted(self, row: list) -> bool:
        for at, kind, value in self.tests:
            x = row[at]
            if x is None:
                return False
            if kind == "in":
                if x not in value:
                    return False
            elif kind == "prefix":
                if not x.startswith(value):
                    return False
            elif not COMPARE[kind](x, value):
                return False
        return True

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        parse = LineParser(self.dialect, self.policy)
        sought = next((v for at, kind, v in self.tests if at == 0 and kind is EqualTo), None)
        names = list(P.FIELDS)
        rows: list[list] = []
        for lines in self._lines(partition):
            for line in lines:
                # The policy 'fail' looks at every line.
                if sought and sought not in line and self.policy != "fail":
                    continue
                row = parse(line)
                if row is not None and self._wanted(row):
                    rows.append(row)
                if len(rows) >= BATCH_LINES:
                    yield self._batch(rows, names)
                    rows = []
        if rows:
            yield self._batch(rows, names)

    def _batch(self, rows: list[list], names: list[str]) -> pa.RecordBatch:
        cols = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, self.types, strict=True)], names=names)


class FilteringReader(AccessLogReader):
    """Takes the filters it can test; Spark keeps the others."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = getattr(f, "attribute", (None,))[0]
            typed = name == "status" and self.types[5] == pa.int32()
            if isinstance(f, (EqualTo, In)) and name == "ip" and self.types[0] == pa.string():
                self.tests.append((0, "in", set(f.value)) if isinstance(f, In) else (0, EqualTo, f.value))
            elif isinstance(f, StringStartsWith) and name == "ip":
                self.tests.append((0, "prefix", f.value))
            elif typed and type(f) in COMPARE:
                self.tests.append((5, type(f), f.value))
            elif typed and isinstance(f, In):
                self.tests.append((5, "in", set(f.value)))
            else:
                yield f


class AccessLogDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def _dialect(self) -> tuple[str, str | None]:
        dialect = self.options.get("dialect", "combined")
        if dialect not in P.DIALECTS:
            raise ValueError(f"unknown dialect {dialect!r}; expected one of {P.DIALECTS}")
        policy = self.options.get("onbadbytes") or ("drop" if dialect == "combined" else None)
        if policy is not None and policy not in P.BYTE_POLICIES:
            raise ValueError(f"unknown byte policy {policy!r}; expected one of {P.BYTE_POLICIES}")
        return dialect, policy

    def schema(self) -> str:
        dialect, policy = self._dialect()
        kinds = {"status": "int" if dialect == "combined" else "string", "bytes": "bigint" if policy else "string"}
        return ", ".join(f"{f} {kinds.get(f, 'string')}" for f in P.FIELDS)

    def reader(self, schema) -> AccessLogReader:
        dialect, policy = self._dialect()
        types = [pa.string()] * 9
        types[5] = pa.int32() if dialect == "combined" else pa.string()
        types[6] = pa.int64() if policy else pa.string()
        kind = FilteringReader if self.options.get("pushdown", "false").lower() == "true" else AccessLogReader
        return kind({k.lower(): v for k, v in self.options.items()}, dialect, policy, types)


def register(spark: SparkSession) -> None:
    """Make the format known to a session. Sessions whose Python path holds this repository
    find it by themselves (package ``pyspark_accesslog``)."""
    spark.dataSource.register(AccessLogDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def create_log_view(
    spark: SparkSession, name: str, files: str, dialect: str = "combined", on_bad_bytes: str | None = None
) -> str:
    """A catalog view ``name`` over raw log files (and the table ``name``_format that it
    scans), parsed on every query, with filters pushed into the reader."""
    register(spark)
    parsing = {"dialect": dialect} | ({"onBadBytes": on_bad_bytes} if on_bad_bytes else {})
    options = ", ".join(f"{k} '{v}'" for k, v in parsing.items())
    scan = ", ".join(f"{k} = '{_escaped(v)}'" for k, v in {"files": files, "pushdown": "true", **parsing}.items())
    base = _quoted(name + "_format")
    spark.sql(f"CREATE TABLE {base} USING {NAME} OPTIONS ({options})")
    spark.sql(f"CREATE VIEW {_quoted(name)} AS SELECT * FROM {base} WITH ({scan})")
    return name


def drop_log_view(spark: SparkSession, name: str) -> None:
    """Drop the view and its table; the files stay."""
    spark.sql(f"DROP VIEW IF EXISTS {_quoted(name)}")
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name + '_format')}")


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")

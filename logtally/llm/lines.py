"""Line dedup by a deletion-neighbourhood join over words.

A line is its words (blank lines stay as they are). Two lines are near if at most ``edits``
word edits (replace, insert or delete) turn one into the other and these are at most a
fifth of the longer line. Equal lines are always near. By default ``edits`` is one: lines
of five or more words with one edit, however long they are. With ``edits=None`` the bound
grows with the line, which is word-edit similarity 0.8. Of equal lines the first stays
(smallest document, then line); a line goes if any earlier line of the input is near.

For one edit:

1. Lines are hashed and grouped; per distinct line the smallest document remains.
2. One edit leaves the first or the last half of the shorter line intact. Only distinct
   lines that share such a half with another one go on, with their texts.
3. Those emit their deletion neighbourhood as hashed keys: for a replaced word the sum of
   hashes (word, position) less that word's; for a deleted word the sum over neighbouring
   pairs with the word taken out, against the other line's full sum. Sums make every key
   an O(1) step from the last, so a line costs its length.
4. Equal keys meet. Lines that differ in one word of the same place are compared with the
   earliest of them only, a shortened line with the full lines; the edit is verified on
   the texts, and the later line goes.

For the growing bound every distinct line goes on, and prefix filtering finds the pairs. An
edit touches at most two of a line's word pairs, so two lines within k edits share one of
the first 2k + 1 different word pairs of each, in any order that is the same for all lines.
The order is rarest first, by counts in 2**16 hash buckets, so a common passage is no key.
Under each key all lines are compared with its earliest one; what is not near that is
compared with all earlier lines that share a key. Edit distances are taken on the texts.

Hashes of lines have 96 bits across documents. Everything is DataFrame functions; groups
are counted by partial aggregates, and joins have a split key only where it is skewed.

Defined results: null text has no lines and keeps none; blank lines stay; null ids come
after all others and do not dedupe each other; rows of equal id and text get equal
results; a row of equal id counts as the same document; an empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import let, reliable, stored

LEAST_WORDS = 5  # the longer line of a near pair
PER_EDIT = 5  # words of the longer line for every edit of the growing bound
BUCKETS = 1 << 16  # of word pairs, counted to find the rare ones
MASK = (1 << 62) - 1
# Runs of gap characters inside a line, and single ones that are not a space.
INNER_GAP = r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]"
INNER_GAPS = ("  ", "\t", "\x0b", "\x0c", "\r")  # every text in which INNER_GAP is found has one


def _plain(text: Column) -> Column:
    """The lines of a text with their words one space apart. Only texts with such gaps are
    searched by the pattern: bytes are compared several times as fast."""
    text = F.coalesce(text, F.lit(""))
    gaps = reduce(or_, (F.contains(text, F.lit(g)) for g in INNER_GAPS))
    return F.split(F.when(gaps, F.regexp_replace(text, INNER_GAP, " ")).otherwise(text), "\n")


def _entries(plain: Column) -> Column:
    """``(h, i)`` of every line with a word, sorted: hash of its words and line number."""
    hashed = F.transform(
        plain, lambda x, i: F.struct(F.when(F.trim(x) != "", F.xxhash64(F.trim(x))).alias("h"), i.alias("i"))
    )
    return F.sort_array(F.filter(hashed, lambda e: e["h"].isNotNull()))


def _again(s: Column, e: Column, k: Column) -> Column:
    """Whether entry ``e``, number ``k`` of the sorted entries ``s``, repeats the one before."""
    return F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))


def parsed_documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The lines of all documents, cut once and written without their texts. One row per
    document and different line (one without a line, if it has none): ``doc``, ``text_hash``;
    hashes ``h`` and ``check`` and number ``i`` of the line and the hashes of its halves; in a
    document's first row also ``n``, its lines with a word, and ``repeats``, the numbers of
    those that repeat an earlier one."""
    ints = "array<int>"

    def lines(plain: Column, s: Column) -> Column:
        repeats = F.transform(F.filter(s, lambda e, k: _again(s, e, k)), lambda e: e["i"])
        each = F.transform(
            F.filter(s, lambda e, k: ~_again(s, e, k)),
            lambda e, k: F.struct(
                e["h"].alias("h"),
                e["i"].alias("i"),
                F.trim(F.get(plain, e["i"])).alias("x"),
                F.when(k == 0, F.size(s).cast("long")).alias("n"),
                F.when(k == 0, repeats).alias("repeats"),
            ),
        )
        nothing = {"h": "long", "i": "int", "x": "string"}
        none = [F.lit(None).cast(t).alias(c) for c, t in nothing.items()]
        empty = F.array(F.struct(*none, F.lit(0).cast("long").alias("n"), F.array().cast(ints).alias("repeats")))
        return F.when(F.size(s) == 0, empty).otherwise(each)

    # One generator, so that the lines are cut once whatever is read of them.
    found = let(_plain(docs[text_col]), lambda plain: let(_entries(plain), lambda s: lines(plain, s)))
    rows = docs.select(docs[id_col].alias("doc"), F.xxhash64(docs[text_col]).alias("text_hash"), F.explode(found).alias("e"))
    x = F.col("e.x")
    # Null for no line. Behind a condition of their own the words would be counted for each use.
    halves = (c.alias(k) for k, c in _halves(x, _count(x)).items())
    check = F.when(x.isNotNull(), F.hash(x)).alias("check")
    return stored(rows.select("doc", "text_hash", "e.h", check, "e.i", *halves, "e.n", "e.repeats"), "line-hashes")


def occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document and different line: ``doc``, ``text_hash``, line hash ``h`` and
    ``check``, line number ``i`` of the first such line, its words ``x``."""
    lines = let(
        _plain(docs[text_col]),
        lambda plain: let(
            _entries(plain),
            lambda s: F.transform(
                F.filter(s, lambda e, k: ~_again(s, e, k)),
                lambda e: F.struct(e["h"].alias("h"), e["i"].alias("i"), F.trim(F.get(plain, e["i"])).alias("x")),
            ),
        ),
    )
    rows = docs.select(
        docs[id_col].alias("doc"), F.xxhash64(docs[text_col]).alias("text_hash"), F.explode(lines).alias("e")
    )
    return rows.select("doc", "text_hash", "e.h", F.hash("e.x").alias("check"), "e.i", "e.x")


def _count(x: Column) -> Column:
    return F.octet_length(x) - F.octet_length(F.replace(x, F.lit(" "), F.lit(""))) + 1


def _head(x: Column, n: Column) -> Column:
    return F.call_function("substring_index", x, F.lit(" "), n)


def _tail(x: Column, n: Column) -> Column:
    return F.call_function("substring_index", x, F.lit(" "), -n)


def _halves(x: Column, n: Column) -> dict[str, Column]:
    """Hashes of the first and last ``n // 2`` and ``(n - 1) // 2`` words, null where no
    near line could share them."""
    a, b = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    long, short = n >= LEAST_WORDS - 1, (n >= LEAST_WORDS) & (a != b)
    return {
        "p1": F.when(long, F.xxhash64(F.lit(0), a, _head(x, a))),
        "s1": F.when(long, F.xxhash64(F.lit(1), a, _tail(x, a))),
        "p2": F.when(short, F.xxhash64(F.lit(0), b, _head(x, b))),
        "s2": F.when(short, F.xxhash64(F.lit(1), b, _tail(x, b))),
    }


def _candidates(distinct: DataFrame) -> DataFrame:
    """``(h, check, first, p, s)``: distinct lines that share a first (p) or last (s) half
    with another distinct line."""
    half = lambda c: F.struct(F.col(c).alias("key"), F.lit(c[0] == "p").alias("front"))
    keys = distinct.select(
        "h", "check", "first", F.explode(F.array(*map(half, ("p1", "s1", "p2", "s2")))).alias("k")
    ).where("k.key is not null").select("h", "check", "first", "k.key", "k.front")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = keys.join(shared.select(F.col("key").alias("shared")), F.col("key") == F.col("shared"))
    return met.groupBy("h", "check").agg(
        F.min("first").alias("first"), F.max("front").alias("p"), F.max(~F.col("front")).alias("s")
    )


def neighbourhood(x: Column, n: Column, p: Column, s: Column) -> Column:
    """The deletion neighbourhood of a line as ``(kind, i, key)``: ``S`` word i replaced,
    ``D`` word i deleted, ``F`` the line as it is. Sums are modulo 2**62."""
    mask = F.lit(MASK)
    less = lambda a, b: (a + (F.lit(MASK) - b + 1)).bitwiseAND(mask)
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda t, v: (t + v).bitwiseAND(mask))
    at = lambda w, i: F.coalesce(F.get(w, i), F.lit(0).cast("long"))
    pair = lambda a, b: F.xxhash64(a, b).bitwiseAND(mask)
    key = lambda kind, i, k: F.struct(F.lit(kind).alias("kind"), i.alias("i"), k.alias("key"))
    sought = lambda i: (p & (i >= F.floor((n - 1) / 2))) | (s & (i <= F.floor(n / 2)))
    places = F.filter(F.sequence(F.lit(0), n - 1), sought)

    def replaced(placed: Column) -> Column:
        every = lambda t: F.transform(
            places, lambda i: key("S", i, F.xxhash64(F.lit("S"), n, i, less(t, F.get(placed, i))))
        )
        return let(total(placed), every)

    def deleted(w: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), n), lambda j: pair(at(w, j - 1), at(w, j)))

        def every(t: Column) -> Column:
            out = lambda i: less(less(t, pair(at(w, i - 1), at(w, i))), pair(at(w, i), at(w, i + 1)))
            new = lambda i: (out(i) + pair(at(w, i - 1), at(w, i + 1))).bitwiseAND(mask)
            whole = F.array(key("F", F.lit(-1), F.xxhash64(F.lit("D"), n, t)))
            return F.concat(
                whole, F.transform(places, lambda i: key("D", i, F.xxhash64(F.lit("D"), n - 1, new(i))))
            )

        return let(total(sums), every)

    words = F.split(x, " ")
    hashes = F.transform(words, lambda w, i: F.xxhash64(w))
    placed = F.transform(words, lambda w, i: F.xxhash64(w, i).bitwiseAND(mask))
    keys = F.concat(let(placed, replaced), let(hashes, deleted))
    return F.filter(keys, lambda k: (n >= LEAST_WORDS) | (k["kind"] == "F"))


def _later(candidates: DataFrame) -> DataFrame:
    """``h, check`` of the candidates (doc, i, h, check, x, n, p, s) near an earlier one."""
    order = F.struct(F.col("doc").isNull().alias("last"), F.col("doc").alias("doc"), F.col("i").alias("line"))
    lines = candidates.select(
        order.alias("order"), F.struct("h", "check").alias("id"), "x", "n",
        F.explode(neighbourhood(F.col("x"), F.col("n"), F.col("p"), F.col("s"))).alias("k"),
    )
    keys = lines.select("order", "id", "n", "k.kind", F.col("k.i").alias("at"), "k.key")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met = reliable(keys.join(shared.select(F.col("key").alias("shared")), F.col("key") == F.col("shared")))
    one = met.where("kind = 'S'").select("key", "order", "id", "n", "at")
    earliest = one.groupBy("key").agg(F.min(F.struct("order", "id")).alias("e"))
    replaced = one.join(earliest, "key").select(
        "id", "order", F.col("e.id").alias("id2"), F.col("e.order").alias("order2"), "n", "at", F.lit(True).alias("same")
    )
    full = met.where("kind = 'F'").select(
        F.col("key").alias("k2"), F.col("id").alias("id2"), F.col("order").alias("order2")
    )
    deleted = met.where("kind = 'D'").join(full, F.col("key") == F.col("k2")).select(
        "id", "order", "id2", "order2", "n", "at", F.lit(False).alias("same")
    )
    pairs = replaced.union(deleted).where("id <> id2")
    text = candidates.select(F.struct("h", "check").alias("t_id"), "x").groupBy("t_id").agg(F.min("x").alias("x"))
    text2 = text.select(F.col("t_id").alias("t_id2"), F.col("x").alias("y"))
    pairs = pairs.join(text, F.col("id") == F.col("t_id")).join(text2, F.col("id2") == F.col("t_id2"))
    at, rest = F.col("at"), F.col("n") - F.col("at") - 1
    x, y = F.col("x"), F.col("y")
    replaces = (_count(y) == F.col("n")) & (_head(x, at) == _head(y, at)) & (_tail(x, rest) == _tail(y, rest))
    shortened = F.array_join(F.filter(F.array(_head(x, at), _tail(x, rest)), lambda z: z != ""), " ")
    verified = pairs.where(F.when(F.col("same"), replaces).otherwise(shortened == y))
    later = F.when(F.col("order") > F.col("order2"), F.col("id")).otherwise(F.col("id2"))
    return verified.select(later.alias("id")).select("id.h", "id.check").distinct()


def _pairs_of_words(x: Column) -> Column:
    """The different pairs of neighbouring words of a line, hashed."""
    paired = lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - 2), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1))
    )
    return F.array_distinct(let(F.transform(F.split(x, " "), lambda w: F.xxhash64(w)), paired))


def _rarity(lines: DataFrame) -> bytes:
    """One byte per hash bucket of word pairs, larger for buckets that more lines hold."""
    pairs = lines.select(F.explode(_pairs_of_words(F.col("x"))).alias("g"))
    counts = pairs.groupBy(F.pmod("g", F.lit(BUCKETS)).cast("int").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    out = bytearray(BUCKETS)
    for b, n in counts.collect():  # at most BUCKETS rows
        out[b] = min(255, int(8 * math.log2(n)))
    return bytes(out)


def _lettered(x: Column, words: Column) -> Column:
    """A line with every word as one character, its place in ``words``."""
    code = lambda w: let(
        F.array_position(words, w) + 0x100, lambda c: F.when(c < 0xD800, c).otherwise(c + 0x800)
    )
    digits = F.transform(F.split(x, " "), lambda w: F.lpad(F.hex(code(w)), 8, "0"))
    return F.decode(F.unhex(F.array_join(digits, "")), "UTF-32")


def _similar(pairs: DataFrame, text: DataFrame) -> DataFrame:
    """The pairs (id, id2, order, order2, n, n2) whose texts are within the growing bound."""
    x, y = (text.select(F.col("id").alias(f"t_{c}"), F.col("x").alias(c)) for c in "xy")
    met = pairs.join(x, F.col("id") == F.col("t_x")).join(y, F.col("id2") == F.col("t_y"))
    words = F.array_distinct(F.split(F.concat_ws(" ", "x", "y"), " "))
    bound = F.floor(F.greatest("n", "n2") / PER_EDIT).cast("int")
    edits = let(
        words, lambda w: F.call_function("levenshtein", _lettered(F.col("x"), w), _lettered(F.col("y"), w), bound)
    )
    return met.where(edits >= 0).select("id", "id2", "order", "order2")


def _later_similar(lines: DataFrame) -> DataFrame:
    """``h, check`` of the lines (doc, i, h, check, x, n) within the growing bound of an
    earlier one."""
    rarity = F.lit(_rarity(lines))
    rank = lambda g: F.substring(rarity, F.pmod(g, F.lit(BUCKETS)).cast("int") + 1, 1)
    ranked = F.sort_array(F.transform(_pairs_of_words(F.col("x")), lambda g: F.struct(rank(g).alias("r"), g.alias("g"))))
    # The other line has at most a quarter more words, so this bounds the edits of any pair.
    most = F.floor(F.col("n") / (PER_EDIT - 1)).cast("int")
    keys = lines.select("h", F.explode(F.slice(ranked, F.lit(1), 2 * most + 1)["g"]).alias("key")).repartition("key")
    # Counted where they were dealt to: the keys are shuffled once, without the rest of the line.
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met = keys.join(shared.select(F.col("key").alias("shared")), F.col("key") == F.col("shared")).select("key", "h")
    order = F.struct(F.col("doc").isNull().alias("last"), F.col("doc").alias("doc"), F.col("i").alias("line"))
    # Rows of equal id and line are one line, at its first place.
    places = lines.groupBy(F.col("h").alias("h1"), "check", "n").agg(F.min(order).alias("order"))
    met = met.distinct().join(places, F.col("h") == F.col("h1"))
    met = reliable(met.select("key", F.struct("h", "check").alias("id"), "n", "order"))
    text = lines.select(F.struct("h", "check").alias("id"), "x").dropDuplicates(["id"])
    fits = F.abs(F.col("n") - F.col("n2")) <= F.floor(F.greatest("n", "n2") / PER_EDIT)

    def near(pairs: DataFrame) -> DataFrame:
        pairs = pairs.where(fits & (F.col("order2") < F.col("order")))
        pairs = pairs.select("id", "id2", "order", "order2", "n", "n2").dropDuplicates(["id", "id2"])
        return _similar(pairs, text).select("id").distinct()

    earliest = met.groupBy("key").agg(F.min(F.struct("order", "id", "n")).alias("e")).select(
        F.col("key").alias("key2"), F.col("e.id").alias("id2"), F.col("e.order").alias("order2"), F.col("e.n").alias("n2")
    )
    first = reliable(near(met.join(earliest, F.col("key") == F.col("key2"))))
    left = met.join(first.select(F.col("id").alias("done")), F.col("id") == F.col("done"), "left_anti")
    others = met.select(
        F.col("key").alias("key2"), F.col("id").alias("id2"), F.col("order").alias("order2"), F.col("n").alias("n2")
    )
    rest = near(left.join(others, F.col("key") == F.col("key2")))
    return first.union(rest).select("id.h", "id.check")


def removed_lines(
    docs: DataFrame, parsed: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int | None = 1
) -> DataFrame:
    """``(doc, text_hash, near, gone)`` for every document that repeats or nearly repeats a
    line of an earlier place: how many of its lines are near ones, and their numbers.
    ``parsed`` is what :func:`parsed_documents` gave for ``docs``."""
    if edits not in (1, None):
        raise ValueError("edits are one, or None for a fifth of the longer line")
    found = occurrences(docs, id_col, text_col)
    lines = parsed.where(F.col("h").isNotNull())
    distinct = lines.groupBy("h", "check").agg(
        F.min("doc").alias("first"),
        F.count(F.lit(1)).alias("times"),
        *(F.max(c).alias(c) for c in ("p1", "s1", "p2", "s2")),
    )
    distinct = stored(distinct, "lines")
    here = (F.col("h") == F.col("h2")) & F.col("doc").eqNullSafe(F.col("first"))
    if edits is None:
        every = distinct.select(F.col("h").alias("h2"), "check", "first")
        texts = found.drop("check").join(every, here).select("doc", "i", "h", "check", "x", _count(F.col("x")).alias("n"))
        # One edit may make five words four.
        near = _later_similar(stored(texts.where(F.col("n") >= LEAST_WORDS - 1), "line-texts"))
    else:
        picked = _candidates(distinct).select(F.col("h").alias("h2"), "check", "first", "p", "s")
        texts = found.drop("check").join(picked, here).select("doc", "i", "h", "check", "x", _count(F.col("x")).alias("n"), "p", "s")
        near = _later(reliable(texts))
    # One verdict for a line that occurs again, one for a line near an earlier one.
    none = F.lit(None).cast(distinct.schema["first"].dataType)
    again = distinct.where("times > 1").select("h", "check", "first", F.lit(False).alias("near"))
    verdict = again.union(near.select("h", "check", none, F.lit(True))).toDF("vh", "vc", "first", "near")
    met = lines.select("doc", "text_hash", "h", "check", "i").join(
        verdict, (F.col("h") == F.col("vh")) & (F.col("check") == F.col("vc"))
    )
    later = F.col("first").isNotNull() & (F.col("doc").isNull() | (F.col("doc") > F.col("first")))
    return met.where(F.col("near") | later).groupBy("doc", "text_hash").agg(
        F.sum(F.col("near").cast("long")).alias("near"), F.collect_set("i").alias("gone")
    )


def _marked(docs: DataFrame, id_col: str, text_col: str, edits: int | None) -> DataFrame:
    """``(id, hash, n, near, gone)`` of every document: its lines with a word, the near ones
    among them, and the numbers of all that go."""
    parsed = parsed_documents(docs, id_col, text_col)
    gone = removed_lines(docs, parsed, id_col, text_col, edits)
    own = parsed.where(F.col("n").isNotNull()).select(F.col("doc").alias("id"), F.col("text_hash").alias("hash"), "n", "repeats")
    joined = own.join(gone, F.col("id").eqNullSafe(F.col("doc")) & (F.col("hash") == F.col("text_hash")), "left")
    # A repeat inside the document goes with or without its first line.
    gone = F.array_union("repeats", F.coalesce("gone", F.array().cast("array<int>")))
    return joined.select("id", "hash", "n", F.coalesce("near", F.lit(0)).alias("near"), F.sort_array(gone).alias("gone"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int | None = 1
) -> DataFrame:
    """One row per document: id, ``n_lines`` (with a word), ``n_removed``, ``n_near`` (the
    different lines among them that nearly repeat an earlier one) and the ``removed`` line
    numbers, from 0, in order."""
    marked = _marked(docs, id_col, text_col, edits)
    return marked.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"),
        F.col("near").cast("long").alias("n_near"),
        F.col("gone").alias("removed"),
    )


def deduped_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int | None = 1
) -> DataFrame:
    """``docs`` with the removed lines taken out of the text, columns unchanged; a document
    that loses all its lines goes."""
    marked = _marked(docs, id_col, text_col, edits).dropDuplicates(["id", "hash"])
    rows = docs.select(
        docs[id_col].alias("doc"), F.xxhash64(docs[text_col]).alias("text_hash"), F.struct("*").alias("row")
    )
    marked = rows.join(marked, F.col("doc").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")))
    text = F.col("row")[text_col]
    kept = let(
        F.split(text, "\n"),
        lambda x: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("gone")), lambda i: F.get(x, i)
            ),
            "\n",
        ),
    )
    kept = F.when(F.size("gone") == 0, text).otherwise(kept)
    left = marked.where((F.size("gone") == 0) | (F.size("gone") < F.col("n")))
    return left.select("row", kept.alias("text_left")).select(
        *(F.col("text_left").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns)
    )

"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from logtally.llm import bpe, chat, common, components, knn, lines, mixing, quality, sharding, simhash, substring
from tests.llm import brute

LONG = " ".join(f"w{i * 7919 % 10007}" for i in range(60_000))
PROSE = "the quick brown fox jumps over the lazy dog and then runs far away from here"
TEXTS = [
    PROSE,
    PROSE,
    PROSE + " today",
    None,
    "",
    " \t\n\x0b\x0c\r",
    "short",
    "two words",
    LONG,
    "x" * 100_000,
    "a b café \U0001f600   <|endoftext|> end\x1c\x1d",
    "same line here again now\nsame line here again now\n\nother line of five words",
    "one two three four five six\none two CHANGED four five six\none two three five six",
]
# Names that the operators use themselves, next to the columns of documents.
EXTRA = (
    "id size crc pos cell salt rank shard slot h x n key row words kept times target text_hash root fp "
    "n_words own gone near t e doc hash ids n_tokens decoded level measure first p s bw bl"
).split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, len(text or ""), *("clash" for _ in EXTRA))


@pytest.fixture(scope="module")
def rows():
    out = [row(i, t, (None, "en")[i % 2], (None, "s1", "s2")[i % 3]) for i, t in enumerate(TEXTS)]
    out += [out[0], out[8], row(None, PROSE), row(None, None, None, None)]  # repeated rows, null ids
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def path():
    return public_tokenizers.path("byte_bpe_50k.json")


def test_sharding(docs, none, rows):
    got = sharding.shard_documents(docs, 3, vnodes=4, cells=16).collect()
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in got) == Counter(
        (r[0], zlib.crc32((r[1] or "").encode()), len((r[1] or "").encode()) + 16) for r in rows
    )
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    assert sharding.shard_documents(none, 3).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_documents(docs, 3, cells=100)


def test_sharding_splits_a_key_of_all_rows_and_moves_little(spark):
    one = spark.range(4000).select(F.lit(7).alias("doc_id"), F.lit("t").alias("text"))
    counts = [r["count"] for r in sharding.shard_documents(one, 8).groupBy("shard").count().collect()]
    assert counts == [500] * 8
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    a, b = (sharding.shard_documents(many, n, load=1.25).select("doc_id", F.col("shard").alias(f"s{n}")) for n in (20, 21))
    moved = a.join(b, "doc_id").where("s20 <> s21").count()
    assert moved < 4000 * 0.3  # a plain modulus would move 95 %
    assert max(r["count"] for r in a.groupBy("s20").count().collect()) <= 250


def test_bpe(docs, none, rows):
    library = Tokenizer.from_file(path())
    want = Counter()
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want[r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), library.decode(ids, skip_special_tokens=False)] += 1
    encoded = bpe.encode_documents(docs, path())
    got = bpe.decode_documents(encoded, path()).collect()
    assert Counter((r.doc_id, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), r.decoded) for r in got) == want
    counted = bpe.count_tokens(docs, path()).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in counted) == Counter((a, b) for a, b, _, _ in want.elements())
    assert {r.n_bytes for r in counted if r.doc_id in (3, 4)} == {0}
    assert bpe.decode_documents(bpe.encode_documents(none, path()), path()).collect() == []
    assert bpe.count_tokens(none, path()).collect() == []


def test_bpe_forced_boundaries_change_nothing():
    with open(path(), encoding="utf-8") as f:
        model = bpe.ByteBPE(f.read())
    library = Tokenizer.from_file(path())
    rng = np.random.default_rng(0)
    for _ in range(300):
        raw = "".join(map(chr, rng.choice([*range(32, 127), 0xE9, 0x4E2D, 0x1F600, 10, 0x85], rng.integers(1, 80))))
        ids = library.encode(raw, add_special_tokens=False).ids
        assert model.encode(raw) == np.array(ids, "<u4").tobytes()
        assert model.count(raw) == len(ids)
    assert any(len(list(model.fragments(x))) > 1 for x in (b"\xe4\xb8\xad\xff\x00", b"zqx\x01\x02"))


def test_quality(docs, none, rows):
    got = quality.quality_rules(docs, min_docs=3).collect()
    verdicts = brute.quality([(r[2], r[3], r[1]) for r in rows], quality.SLACK, 3)
    want = Counter()
    for r, kept in zip(rows, verdicts, strict=True):
        m = brute.base_measures(r[1])
        want[r[0], m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"], brute.base_failed(m), kept] += 1
    assert Counter(map(tuple, got)) == want
    left = quality.quality_filter(docs, min_docs=3)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(r[0] for r, k in zip(rows, verdicts, strict=True) if k)
    assert quality.quality_rules(none).collect() == [] and quality.quality_filter(none).collect() == []


def test_repeated_words_overlap(spark):
    text = "a b c d e x a b c d e a b c d e y " + "z " * 12
    df = spark.createDataFrame([(1, text, "en", "s")], "doc_id long, text string, lang string, source string")
    assert quality.quality_rules(df).first().n_repeat_words == brute.base_measures(text)["n_repeat_words"]


def test_sketch_buckets(spark):
    values = [*range(200), 1000, 4095, 4096, 10**6, 2**40 + 17]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = df.select("v", quality.bucket_end(quality.bucket(F.col("v"))).alias("e")).collect()
    assert {r.v: r.e for r in got} == {v: brute.bucket_end(v) for v in values}


def test_mixing(docs, none, rows):
    got = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((r[0], r[3], len(brute.words(r[1]))) for r in rows)
    assert {r.times for r in got} <= {0, 1, 2, 3}
    again = mixing.mix(docs).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    repeated = mixing.mixed_documents(docs)
    assert repeated.columns == docs.columns
    want = Counter()
    for r in got:
        want[r.doc_id, r["size"]] += r.times
    seen = Counter((r.doc_id, len(brute.words(r.text))) for r in repeated.collect())
    assert seen == +want
    assert mixing.mix(none).collect() == [] and mixing.mixed_documents(none).collect() == []


def test_mixing_hits_capped_and_reshared_targets(spark):
    # Source "a" (weight 5) is tiny and stops at 3 times its size; b, c share the excess.
    data = [(i, "w " * 3, "a") for i in range(10)] + [(100 + i, "w " * (1 + i % 5), "bc"[i % 2]) for i in range(2000)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    target = {r.source: r.target for r in got}
    size = {r.source: r.source_size for r in got}
    total = sum(size.values())
    assert target["a"] == 3 * size["a"]
    assert target["b"] == pytest.approx((total - target["a"]) * 2 / 3)
    assert target["c"] == pytest.approx((total - target["a"]) / 3)
    for s in "abc":
        assert abs(sum(r["size"] * r.times for r in got if r.source == s) - target[s]) <= 5


def knn_brute(data, k):
    """Every query row's best other rows, in Python's integers."""
    rows = [
        (i, [math.floor(1024 * float(np.float64(e))) for e in x])
        for i, x in data
        if i is not None and x is not None and all(e is not None and math.isfinite(e) for e in x)
    ]
    out = []
    for at, (i, q) in enumerate(rows):
        if i % 100 == 0:
            scored = sorted(
                (-sum(a * b for a, b in zip(q, x, strict=True)), j)
                for n, (j, x) in enumerate(rows)
                if n != at and len(x) == len(q)
            )
            out += [(i, r, j, max(-(2**63), min(2**63 - 1, -s))) for r, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_knn(spark):
    nan, inf = float("nan"), float("inf")
    data = [(i, [0.5, -0.25]) for i in range(30)] + [(100, [1.0, 1.0]), (101, None), (102, [1.0, None]), (200, [nan, 0.0])]
    data += [(300, [inf, 1.0]), (400, [3.0]), (500, []), (None, [1.0, 1.0]), (100, [1.0, 1.0]), (600, [-0.0005, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumns({c: F.lit("clash") for c in ("id", "row", "x")})
    got = knn.top_k(df, F.expr("vec_id % 100 = 0"), k=5, shard_rows=7, block_rows=2).collect()
    assert sorted(map(tuple, got)) == knn_brute(data, 5)
    assert {r.query_id for r in got} == {0, 100, 600}  # 400 and 500 have no candidate of their length
    assert knn.top_k(df.limit(0), F.expr("vec_id % 100 = 0")).collect() == []


@pytest.mark.parametrize("power", [8, 22, 27, 40, 60])
def test_knn_large_components(spark, power):
    """Scores and box bounds beyond 62 bits, few large rows among small ones, repeated ids."""
    rng = np.random.default_rng(power)
    data = [(int(i) % 150, (rng.integers(-8, 9, 4) * (2.0**power if i % 7 == 0 else 0.125)).tolist()) for i in range(220)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    got = knn.top_k(df, F.expr("vec_id % 100 = 0"), k=6, shard_rows=50, block_rows=3)
    exact = power < 60
    want = knn_brute(data, 6)
    got = sorted(map(tuple, got.collect()))
    assert got == want if exact else [r[:2] + r[3:] for r in got] == [r[:2] + r[3:] for r in want]


def test_knn_wide_vectors(spark):
    """Sums over many components that pass a long although each product is small."""
    dim, big = 256, 2.0**18 - 1
    data = [(0, [big] * dim), (1, [big] * dim), (2, [-big] * dim), (3, [1.0] * dim), (5, [2.0**18] * dim), (5, [1.0] * dim)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = knn.top_k(df, F.expr("vec_id = 0"), k=5, shard_rows=2, block_rows=1)
    assert sorted(map(tuple, got.collect())) == [r for r in knn_brute(data, 5) if r[0] == 0]


def test_knn_prunes_and_finds_all():
    rng = np.random.default_rng(1)
    points = rng.integers(-1024, 1024, (3000, 6))
    tree = knn.KDTree(np.arange(3000), points, leaf=16)
    q = rng.integers(-1024, 1024, (5, 6))
    for n, bound in enumerate(tree.bounds(q)):
        ids, scores = tree.search(-1, q[n], bound, 10, None)
        full = points @ q[n]
        want = np.lexsort((np.arange(3000), -full))[:10]
        assert ids.tolist() == want.tolist() and scores.tolist() == full[want].tolist()
        # With the k-th result known before, only the nine better ones come back.
        better, _ = tree.search(-1, q[n], bound, 10, (int(scores[-1]), int(ids[-1])))
        assert better.tolist() == want[:9].tolist()


def test_lines(docs, none, rows):
    got = lines.dedup_lines(docs).collect()
    assert len(got) == len(rows)
    known = {r[0]: r[1] for r in rows if r[0] is not None}
    want = brute.line_dedup(list(known.items()))
    for r in got:
        if r.doc_id is not None:
            assert r.removed == want[r.doc_id], r.doc_id
            assert r.n_lines == sum(bool(brute.words(x)) for x in (known[r.doc_id] or "").split("\n"))
    assert sorted(r.removed for r in got if r.doc_id is None) == [[], [0]]  # ids come before no id
    left = lines.deduped_documents(docs)
    assert left.columns == docs.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[0] == PROSE and 1 not in texts and 2 not in texts and texts[4] == "" and texts[3] is None
    assert lines.dedup_lines(none).collect() == [] and lines.deduped_documents(none).collect() == []


def test_lines_edit_bound(spark):
    base = [f"w{i}" for i in range(12)]
    data = [
        " ".join(base),
        " ".join([*base[:4], "X", *base[5:]]),  # replaced: near
        " ".join([*base[:7], "X", *base[7:]]),  # inserted: near
        " ".join(base[1:]),  # first word deleted: near
        " ".join([*base[:3], "X", "Y", *base[5:]]),  # two words: kept
        "a b c d",
        "a b c X",  # four words: kept
        "a b c d e",  # five against four: near
        "b a c d e f g h i j k l",
        "a b c d e f g h i j k l",  # two places: kept
    ]
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")
    got = {r.doc_id: r.removed for r in lines.dedup_lines(df).collect()}
    assert got == brute.line_dedup(list(enumerate(data)))
    assert [k for k, v in sorted(got.items()) if v] == [1, 2, 3, 7]


def test_lines_a_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(30)]
    data = [(k, " ".join([*base[: k % 30], f"v{k}", *base[k % 30 + 1 :]])) for k in range(400)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert {r.doc_id: r.removed for r in lines.dedup_lines(df).collect()} == brute.line_dedup(data)


def test_lines_bound_grows_with_the_line(spark):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = np.random.default_rng(11)
    base = [[f"w{x}" for x in rng.integers(0, 60, n)] for n in (4, 5, 9, 10, 14, 20, 33, 57)]
    data = []
    for _ in range(240):
        w = list(base[int(rng.integers(0, len(base)))])
        for _ in range(int(rng.integers(0, len(w) // 4 + 2))):
            at, new = int(rng.integers(0, len(w))), f"w{int(rng.integers(0, 60))}"
            w[at : at + int(rng.integers(0, 2))] = [[new], []][int(rng.integers(0, 2))]
            w = w or [new]
        data.append(" ".join(w))
    data += ["a " * 10, "a " * 8 + "b c", "a " * 7 + "b c d", "shared passage of common words here " * 3 + "x y z"]
    seen, want = [], {}
    for k, line in enumerate(data):
        w = line.split()
        if w in seen or any(5 * distance(w, o) <= max(len(w), len(o)) for o in seen):
            want[k] = [0]
        seen.append(w)
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")
    got = {r.doc_id: r.removed for r in lines.dedup_lines(df, edits=None).collect() if r.removed}
    assert got == want
    assert len(got) > len([r for r in lines.dedup_lines(df).collect() if r.removed])


def test_chat(spark):
    trap = "\\### Assistant: </turn> ok\\b\\l<turn>x\n</turn>\n\\\\l"
    data = [
        (1, 0, "user", trap), (1, 1, "assistant", trap), (1, 1, "assistant", trap), (1, None, "system", None),
        (2, 5, None, "x" * 5000), (2, 4, "assistant", "y" * 513), (None, 0, "us\ner<\\", ""), (3, 0, "assistant", "é\U0001f600" * 600),
    ]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(data, schema).withColumns({c: F.lit("clash") for c in ("seq", "kind", "message", "formatted")})
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert [tuple(t) for t in got[1].turns] == [("system", ""), ("user", trap), ("assistant", trap), ("assistant", trap)]
    assert got[1].loss_text == trap * 2 and got[1].n_turns == 4
    assert [tuple(t) for t in got[2].turns] == [("assistant", "y" * 513), ("", "x" * 5000)]
    assert [tuple(t) for t in got[None].turns] == [("us\ner<\\", "")] and got[None].loss_text == ""
    assert got[3].loss_text == "é\U0001f600" * 600
    assert chat.format_conversations(df.limit(0)).collect() == []


def test_chat_events_fold(spark):
    log = [
        (1, 0, "start", "user", ""), (1, 1, "delta", None, "He"), (1, 2, "delta", None, "llo"),
        (1, 3, "edit", None, "Bye"), (1, 4, "delta", None, "!"),
        (2, 5, "start", "assistant", ""), (2, 6, "delta", None, "draft"), (2, 7, "regenerate", None, ""),
        (2, 8, "delta", None, "fi"), (2, 9, "delta", None, "nal"),
    ]
    df = spark.createDataFrame(log, "message int, seq int, kind string, role string, text string").withColumn("conv_id", F.lit(1))
    got = {r.message: (r.role, r.text) for r in chat.fold_events(df.orderBy(F.desc("seq"))).collect()}
    assert got == {1: ("user", "Bye!"), 2: ("assistant", "final")}


def fold_brute(log):
    """Final messages of one conversation's events, by the sequence of their starts."""
    texts, roles, starts = {}, {}, {}
    for seq, message, kind, role, at, size, text in sorted(log, key=lambda e: e[0]):
        now, text = texts.setdefault(message, ""), text or ""
        roles[message] = max(filter(None, (roles.get(message), role)), default=None)
        starts.setdefault(message, []).append((kind != "start", seq))
        if kind == "delta":
            texts[message] = now + text
        elif kind == "edit" and at is not None:
            texts[message] = now[:at] + text + now[at + (size or 0) :]
        elif kind in ("start", "edit", "regenerate"):
            texts[message] = text
    return [(roles[m] or "", texts[m]) for m in sorted(starts, key=lambda m: min(starts[m])[1])]


def test_chat_foreign_logs(spark):
    """Logs that this module did not make: messages named by text, events of several messages
    interleaved, partial edits, several regenerations, unknown kinds, no start."""
    rng = np.random.default_rng(6)
    logs = {}
    for conv in range(40):
        seqs = rng.permutation(1000)[: int(rng.integers(1, 30))].tolist()
        log, begun = [], set()
        for seq in sorted(seqs):
            m = f"m{rng.integers(4)}"
            kind = "start" if m not in begun and rng.random() < 0.9 else str(rng.choice(["delta", "delta", "edit", "regenerate", "note"]))
            begun.add(m)
            at = int(rng.integers(0, 9)) if kind == "edit" and rng.random() < 0.7 else None
            text = None if kind in ("start", "regenerate") else "".join(rng.choice(list("ab<\\é"), int(rng.integers(0, 6))))
            role = ("user", "assistant")[int(m[1]) % 2] if kind == "start" else None
            log.append((seq, m, kind, role, at, None if at is None else int(rng.integers(0, 4)), text))
        logs[conv] = log
    rows = [(conv, *e) for conv, log in logs.items() for e in log]
    schema = "conv_id long, seq long, message string, kind string, role string, at int, size int, text string"
    df = spark.createDataFrame(rows, schema).repartition(7)
    got = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold_events(df))).collect()}
    for conv, log in logs.items():
        want = fold_brute(log)
        assert [tuple(t) for t in got[conv].turns] == want, conv
        assert got[conv].loss_text == "".join(x for role, x in want if role == "assistant")


def test_chat_events_interleave(spark):
    """The events made from turns: numbered per conversation, earlier deltas count."""
    df = spark.createDataFrame([(1, 0, "user", "abc"), (1, 1, "assistant", "d" * 1200), (1, 2, "user", "")], "conv_id int, turn int, role string, text string")
    events = sorted(chat.conversation_events(df).collect(), key=lambda e: e.seq)
    assert len({e.seq for e in events}) == len(events)
    order = [e.message for e in events]
    assert order != sorted(order)  # a message's last event comes after the next one's start
    assert [e.text for e in events if e.message == 1] == ["", "?bc", "a"]
    turns = chat.read_back(chat.format_conversations(df)).first().turns
    assert [tuple(t) for t in turns] == [("user", "abc"), ("assistant", "d" * 1200), ("user", "")]


def test_substring(docs, none, rows):
    known = [(r[0], r[1]) for r in rows if r[0] is not None]
    want = brute.substring_dedup(known)
    got = substring.remove_repeats(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.kept) == want[r.doc_id]
    assert substring.remove_repeats(none).collect() == []


def test_substring_blocks_and_offsets(spark, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK", 50)  # many blocks: every row settled by the shuffle
    rng = np.random.default_rng(2)
    passage = [f"p{i}" for i in range(40)]
    data = []
    for k in range(120):
        w = [f"d{k}_{i}" for i in range(int(rng.integers(0, 30)))]
        a = int(rng.integers(0, 25))
        n = int(rng.integers(10, 16))
        data.append((k, " ".join([*w, *passage[a : a + n], f"end{k}"])))
    want = brute.substring_dedup(data)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(df).collect()}
    assert got == want and sum(x[1] for x in got.values()) > 100


@pytest.mark.parametrize("period", range(1, 14))
def test_difference_cover(period):
    cover = substring.difference_cover(period)
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))


def test_simhash(docs, none, rows):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    known = {r[0]: r[1] for r in rows if r[0] is not None}
    want = brute.simhash_components(list(known.items()))
    for r in got:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == want[r.doc_id]
    assert {r.component_id for r in got if r.doc_id is None} == {0, 3}
    kept = simhash.deduped_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want.values()})
    assert simhash.near_duplicates(none).collect() == [] and simhash.deduped_documents(none).collect() == []


@pytest.mark.parametrize(("max_bits", "hot"), [(0, 1), (1, 1), (1, 1000), (2, 1), (2, 20), (2, 1000), (3, 30)])
def test_simhash_links_in_dense_groups(spark, max_bits, hot):
    rng = np.random.default_rng(3)
    fps = set()
    for _ in range(6):
        centre = int(rng.integers(0, 2**63))
        for _ in range(60):
            f = centre
            for b in rng.integers(0, 63, int(rng.integers(0, 5))):
                f ^= 1 << int(b)
            fps.add(f)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.node: r.component for r in components.components(simhash.links(df, max_bits, hot)).collect()}
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    assert {f: got.get(f, f) for f in fps} == {f: root(f) for f in fps}


@pytest.mark.parametrize("max_bits", [3, 4])
def test_simhash_links_beyond_two_bits(spark, max_bits):
    rng = np.random.default_rng(5)
    fps = {0, -1, -(2**63)}
    for _ in range(8):
        centre = int(rng.integers(-(2**63), 2**63 - 1))
        for _ in range(12):
            bits = sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 6)), replace=False))
            fps.add(((centre ^ bits) + 2**63) % 2**64 - 2**63)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits
    pairs = simhash.links(df, max_bits).distinct().collect()
    assert all(near(r.a, r.b) for r in pairs)
    got = {r.node: r.component for r in components.components(simhash.links(df, max_bits)).collect()}
    want = {f: f for f in fps}
    while True:
        new = {f: min(want[g] for g in fps if near(f, g)) for f in fps}
        if new == want:
            break
        want = new
    assert {f: got.get(f, f) for f in fps} == want


def test_components_of_a_path_and_a_star(spark):
    path_links = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 1001)]
    df = spark.createDataFrame(path_links + star + star + [(7, 7)], "a long, b long")
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == {**dict.fromkeys(range(201), 0), **dict.fromkeys([*range(1000, 1300), 5000], 1000)}


def test_pipeline_stages_keep_columns_and_take_empty_tables(spark, docs, none):
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, none, "").collect() == []
        out = stage(spark, docs, "")
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns
        out.collect()


def test_let_evaluates_once(spark):
    df = spark.range(3).select(common.let(F.rand(), lambda v: v == v).alias("same"))
    assert all(r.same for r in df.collect())

"""Each pipeline stage against a brute-force version on its own input."""

from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from logtally.llm import quality
from tests.conftest import SF_SMALL
from tests.llm import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [[r.asDict() for r in docs.collect()]]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == COLUMNS
        out.append([r.asDict() for r in docs.collect()])
    return out


def key(r):
    return tuple(r[c] for c in COLUMNS)


def test_quality_rules(steps):
    verdicts = brute.quality([(d["lang"], d["source"], d["text"]) for d in steps[0]], quality.SLACK, quality.MIN_DOCS)
    assert Counter(map(key, steps[1])) == Counter(key(d) for d, ok in zip(steps[0], verdicts, strict=True) if ok)


def test_line_dedup(steps):
    removed = brute.line_dedup([(d["doc_id"], d["text"]) for d in steps[1]])
    want = Counter()
    for d in steps[1]:
        gone = set(removed[d["doc_id"]])
        lines = d["text"].split("\n")
        if gone and not any(brute.words(x) for i, x in enumerate(lines) if i not in gone):
            continue
        want[key(d | {"text": "\n".join(x for i, x in enumerate(lines) if i not in gone)})] += 1
    assert Counter(map(key, steps[2])) == want


def test_near_dedup(steps):
    groups = brute.simhash_components([(d["doc_id"], d["text"]) for d in steps[2]])
    assert Counter(map(key, steps[3])) == Counter(key(d) for d in steps[2] if groups[d["doc_id"]][1] == d["doc_id"])


def test_mixing(steps):
    before, after = {key(d): d for d in steps[3]}, Counter(map(key, steps[4]))
    assert set(after) <= set(before) and max(after.values()) <= 3
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for k, d in before.items():
        n = len(brute.words(d["text"]))
        sizes[d["source"]] += n
        taken[d["source"]] += n * after[k]
        largest[d["source"]] = max(largest[d["source"]], n)
    order = sorted(sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total = sum(sizes.values())
    if all(total * weight[s] / sum(weight.values()) <= 3 * sizes[s] for s in order):
        for s in order:
            assert abs(taken[s] - total * weight[s] / sum(weight.values())) <= largest[s]


def test_encoding(steps):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {d["doc_id"]: d["text"] for d in steps[4]}
    assert Counter(r["doc_id"] for r in steps[5]) == Counter(d["doc_id"] for d in steps[4])
    for r in steps[5]:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids"] == b"".join(i.to_bytes(4, "little") for i in ids)
        assert r["decoded_sha256"] == brute.sha(texts[r["doc_id"]])


def test_run_gives_the_last_stage(spark, steps):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert Counter((r["doc_id"], r["ids_sha256"]) for r in rows) == Counter(
        (r["doc_id"], r["ids_sha256"]) for r in steps[5]
    )

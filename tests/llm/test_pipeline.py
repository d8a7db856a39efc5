"""The pipeline against a brute-force version of each stage."""

import random

import corpus_pipeline
from cairnstat.llm import langid
from cairnstat.llm.common import tokenizer_path
from tokenizers import Tokenizer

from . import fixtures
from .test_operators import check_packing

SPACE = " \t\n\x0b\f\r"


def test_stages_against_brute_force(spark, tmp_path):
    rows = fixtures.odd_documents(11)
    docs = spark.createDataFrame(rows, fixtures.SCHEMA)
    got = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        got.append(docs)
    columns = [c.split()[0] for c in fixtures.SCHEMA.split(", ")]
    assert all(d.columns == columns for d in got[:-1])
    of = lambda d: sorted((r.doc_id, r.text) for r in d.collect())

    learn = spark.createDataFrame([r for r in rows if not langid.is_held_out(r[0])], fixtures.SCHEMA)
    model = langid.fit(learn)
    named = [(r[0], r[1], langid.label_texts(model, [r[1]], langid.PENALTY)[0]) for r in rows]
    left = sorted((d, t) for d, t, (lang, score, _) in named if lang != "und" and score >= corpus_pipeline.LEAST_SCORE)
    assert of(got[0]) == left

    gone = fixtures.dropped_lines(left)
    cleaned = []
    for d, t in left:
        lines = t.split("\n")
        kept = [x for n, x in enumerate(lines) if (d, n) not in gone]
        if len(kept) == len(lines) or "".join(kept).strip(SPACE):
            cleaned.append((d, "\n".join(kept)))
    assert of(got[1]) == sorted(cleaned)

    groups = fixtures.near_components(cleaned)
    one = sorted({(d, t) for d, t in cleaned if groups[d][1] == d})  # of rows that repeat each other one stays
    assert of(got[2]) == sorted(one)

    bare = [(d, raw.decode("utf-8", "ignore")) for (d, _), (raw, _) in zip(one, fixtures.without_passages([t for _, t in one]), strict=True)]
    bare = [(d, t) for d, t in bare if t.strip(SPACE)]
    assert of(got[3]) == sorted(bare)

    lib = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    total = sum(1 + len(lib.encode(t, add_special_tokens=False).ids) for _, t in bare)
    check_packing(got[4].collect(), total, 4096)


def test_repeated_and_null_keys(spark, tmp_path):
    """No text is lost that only shares its key with others; of equal rows one stays, and the passage stage leaves it alone."""
    rng = random.Random(8)
    a, b, c, d, e = (fixtures.prose(rng, 200) for _ in range(5))
    rows = [(5, a), (7, a + " end"), (7, b), (9, c), (9, c), (9, d), (None, e), (None, e)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t), "x", "y", "z", None, "k", "v") for k, t in rows], fixtures.SCHEMA)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[1:4]):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    of = lambda rows: sorted(((x, y) for x, y in rows), key=str)
    got = of((r.doc_id, r.text) for r in docs.collect())
    assert [t for _, t in got if t in (b, c, d, e)].count(c) == 1 and got == of([(5, a), (7, b), (9, c), (9, d), (None, e)])


def test_passages_of_over_50_words_go(spark, tmp_path):
    """A passage of 55 words in under 400 bytes that stands in several documents goes from them, and nothing else does."""
    rng = random.Random(12)
    shared = fixtures.prose(rng, 55).replace("\n", " ")
    assert len(shared) < 400
    own = [fixtures.prose(rng, 120) for _ in range(8)]
    rows = [(k, f"{t} {shared} {t[::-1]}" if k < 4 else t) for k, t in enumerate(own)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t), "x", "y", "z", None, "k", "v") for k, t in rows], fixtures.SCHEMA)
    got = {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["suffix-array dedup"](spark, docs, str(tmp_path)).collect()}
    assert got == {k: f"{t}  {t[::-1]}" if k < 4 else t for k, t in enumerate(own)}


def test_null_doc_ids(spark, tmp_path):
    rng = random.Random(3)
    row = lambda d: (d, fixtures.prose(rng, 200), "en", "s", 1, "x", "y", "z", None, "k", "v")
    null, lone = row(None), row(2)
    docs = spark.createDataFrame([null, lone], fixtures.SCHEMA)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[1:]):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert sorted((r.doc_id for r in docs.filter("piece = 0").collect()), key=str) == [2, None]


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], fixtures.SCHEMA)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() == 0

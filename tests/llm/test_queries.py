"""The registered queries that SQL can't express, each by its name, against brute force over the whole small table."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from cairnstat.llm.common import tokenizer_path
from cairnstat.llm.queries import QUERIES

from . import fixtures


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: r.text for r in sorted(rows, key=lambda r: r.doc_id)}


def answer(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir).collect()


def library_ids(file, texts):
    found = Tokenizer.from_file(tokenizer_path(file))
    found.no_truncation()
    found.no_padding()
    return {k: found.encode(t or "", add_special_tokens=False).ids for k, t in texts.items()}, found


def packed_ids(ids):
    return np.array(ids, "<u4").tobytes()


def test_op1(spark, sf_dir, texts):
    got = answer(spark, sf_dir, "op1_language")
    assert sorted(r.doc_id for r in got) == list(texts)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or ""))


def test_op3(spark, sf_dir, texts):
    got = answer(spark, sf_dir, "op3_gif")
    assert sorted(r.doc_id for r in got) == list(texts)
    stored = {}
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        payload = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert stored.setdefault(raw, (r.media_bytes, r.media_sha256, r.feature)) == (r.media_bytes, r.media_sha256, r.feature)
        levels = np.bincount(np.frombuffer(payload, np.uint8) // 16, minlength=16)
        assert r.feature.split(";")[0] == ",".join(map(str, levels.tolist()))


def test_op4(spark, sf_dir, texts):
    ids, lib = library_ids("byte_bpe_50k.json", texts)
    want = [(k, len(v), hashlib.sha256(packed_ids(v)).hexdigest(), hashlib.sha256(lib.decode(v, skip_special_tokens=False).encode()).hexdigest()) for k, v in ids.items()]
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in answer(spark, sf_dir, "op4_bpe")) == want


def test_op5(spark, sf_dir, texts):
    want, start = [], 0
    for k, v in library_ids("word_bpe_49k.json", texts)[0].items():
        want.append((k, start, len(v) + 1, zlib.crc32(packed_ids([*v, 2]))))
        start += len(v) + 1
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in answer(spark, sf_dir, "op5_tokens")) == want


def test_op6(spark, sf_dir, texts):
    want, total = [], 0
    for k, v in library_ids("word_bpe_49k.json", texts)[0].items():
        v = [*v, 1]
        total += len(v)
        want += [(k, n, n * 4096, len(v[a : a + 4096]), zlib.crc32(packed_ids(v[a : a + 4096]))) for n, a in enumerate(range(0, len(v), 4096))]
    got = answer(spark, sf_dir, "op6_packing")
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(held) == -(-total // 4096)


def test_op7(spark, sf_dir, texts):
    want = fixtures.without_passages(texts.values())
    sizes = {k: len((t or "").encode()) for k, t in texts.items()}
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in answer(spark, sf_dir, "op7_passages"))
    assert got == [(k, sizes[k], sizes[k] - len(kept), spans, hashlib.sha256(kept).hexdigest()) for k, (kept, spans) in zip(texts, want, strict=True)]


def test_op7_passages_of_words(spark, sf_dir, texts, tmp_path):
    """Passages of 50 words and more show in columns of their own, if they have fewer than 400 bytes as well; the others are as before."""
    rng = random.Random(21)
    short = fixtures.prose(rng, 55).replace("\n", " ").strip()
    assert len(short) < 400
    planted = {k: f"{fixtures.prose(rng, 60)} {short * (k < 3)} {fixtures.prose(rng, 60)}" for k in range(5)}
    spark.createDataFrame(list(planted.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for where, table in ((str(tmp_path), planted), (sf_dir, texts)):
        got = {r.doc_id: (r.n_removed, r.n_passage_bytes, r.n_passages) for r in answer(spark, where, "op7_passages")}
        assert {k: g[1:] for k, g in got.items()} == dict(zip(table, fixtures.passages_and_words(table.values()), strict=True))
        assert where == sf_dir or all(g[0] == 0 and (g[1:] == (len(short), 1) if k < 3 else g[1] == 0) for k, g in got.items())


def test_op8(spark, sf_dir, texts):
    got = answer(spark, sf_dir, "op8_sharding")
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == [(k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in texts.items()]
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values()) and set(slots) <= set(range(16))
    counts = Counter(r.shard for r in got)
    assert max(counts[s] for s in range(16)) - min(counts[s] for s in range(16)) <= 1


def test_op9(spark, sf_dir, texts):
    want = fixtures.near_components(texts.items())
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in answer(spark, sf_dir, "op9_neardup")}
    assert got == want

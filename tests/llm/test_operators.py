import hashlib
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cairnstat.llm import bpe, bwt, langid, linededup, media, neardup, packing, passages, quality, queries, sharding, tokenfile
from cairnstat.llm.common import shared_dir, tokenizer_path

from ..compare import same
from . import fixtures


@pytest.fixture(scope="module")
def rows():
    return fixtures.odd_documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, fixtures.SCHEMA)


@pytest.fixture(scope="module")
def texts(rows):
    return {r[0]: r[1] for r in rows}


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], fixtures.SCHEMA)


@pytest.fixture(scope="module")
def unkeyed(spark):
    return spark.createDataFrame([(None, "some words that stand here without a key at all.", None, None, None, *[None] * 6), (1, None, None, None, None, *[None] * 6)] * 2, fixtures.SCHEMA)


# ---- SQL ----


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf_dir, duck, name):
    same(queries.QUERIES[name](spark, sf_dir).toPandas(), duck.execute(queries.ORACLE_SQL[name]).df())


@pytest.mark.parametrize(("operator", "name"), [(quality.op2_quality, "op2_quality"), (linededup.op10_lines, "op10_lines")])
def test_sql_on_odd_documents(spark, docs, tmp_path, operator, name):
    import duckdb

    docs.dropDuplicates(["doc_id"]).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    same(operator(spark, str(tmp_path)).toPandas(), con.execute(queries.ORACLE_SQL[name]).df())


# ---- 1: languages ----


def test_viterbi_is_exact():
    rng = np.random.default_rng(0)
    lens = rng.integers(0, 300, 12)
    scores, doc = rng.normal(size=(lens.sum(), 3)) * 3, np.repeat(np.arange(12), lens)
    got, at = langid.viterbi(scores, doc, 12, 2.0), 0
    for n in lens:
        own, path = scores[at : at + n], got[at : at + n]
        if n:
            best = own[0].copy()
            for t in range(1, n):
                best = np.maximum(best, best.max() - 2.0) + own[t]
            assert own[np.arange(n), path].sum() - 2.0 * (np.diff(path) != 0).sum() == pytest.approx(best.max())
        at += n


def test_language_held_out(spark, sf_dir):
    got = langid.op1_language(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    own = got[got.held_out]
    assert len(own) > 20 and (own.lang_pred == own.lang).mean() >= 0.97
    assert got.score.between(0, 1).all() and (got.held_out == got.doc_id.map(langid.is_held_out)).all()


def test_viterbi_with_many_languages():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(300, 140)) * 3
    path = langid.viterbi(scores, np.zeros(300, int), 1, 4.0)
    best = scores[0].copy()
    for t in range(1, 300):
        best = np.maximum(best, best.max() - 4.0) + scores[t]
    assert scores[np.arange(300), path].sum() - 4.0 * (np.diff(path) != 0).sum() == pytest.approx(best.max())


def test_long_text_is_read_in_slices(spark, sf_dir, monkeypatch):
    model = langid.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text = " ".join(r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").filter("text is not null").limit(40).collect())
    whole = langid.label_texts(model, [text], langid.PENALTY, True)
    monkeypatch.setattr(langid, "CHARS_AT_ONCE", 500)
    monkeypatch.setattr(langid, "WORDS_AT_ONCE", 50)
    assert langid.label_texts(model, [text], langid.PENALTY, True) == whole and len(whole[0][2]) > 3


def test_draw_limit():
    assert langid.draw_limit(5, 5) == langid.draw_limit(5, 1) == (1 << 63) - 1
    for n in (10**4, 10**10, 10**14):
        share = (langid.draw_limit(1500, n) + (1 << 63) + 1) / (1 << 64)
        assert share == pytest.approx(1500 / n, rel=1e-3)


def test_word_scores_against_a_plain_loop(spark, sf_dir):
    """The score of a word is the sum of the weights of its n-grams, marks at both ends included."""
    model = langid.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    mask = (1 << 64) - 1
    for word in ["haus", "l", "été", "information"]:
        marked, want = [1, *map(ord, word), 2], np.zeros(len(model.langs))
        for a in range(len(marked)):
            rolled = 0
            for k, n in enumerate(langid.LENGTHS):
                if a + n > len(marked):
                    break
                rolled = (rolled * 0x9E3779B97F4A7C15 + marked[a + k] + n) & mask
                want += model.weights[((((rolled ^ (rolled >> 29)) * 0xBF58476D1CE4E5B9) & mask) >> 48) % langid.BUCKETS]
        assert model.score(langid.split_words([word]))[0] == pytest.approx(want, abs=1e-3)


def test_language_spans(spark, sf_dir):
    model = langid.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    both = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("lang in ('en', 'de') and n_chars > 400").groupBy("lang").agg(F.first(F.substring("text", 1, 400)).alias("t"))
    t = {r.lang: r.t for r in both.collect()}
    spans = langid.label_texts(model, [t["en"] + " " + t["de"]], langid.PENALTY, True)[0][2]
    assert [s[2] for s in spans] == ["en", "de"] and abs(spans[0][1] - 400) < 20


def test_language_cases(spark, docs, none, unkeyed, rows):
    model = langid.fit(docs)
    got = langid.label(docs, model).select("doc_id", "text", "lang_pred", "score", "shard").collect()
    assert len(got) == len(rows)
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (r.score > 0) == letters
    assert langid.label(none, model).count() == 0 and langid.label(unkeyed, langid.fit(none)).filter("lang_pred = 'und'").count() == 4


# ---- 3: GIF ----


def slow_lzw(stream, bits):
    clear, out, acc, n, width, table, before = 1 << bits, bytearray(), 0, 0, bits + 1, [], None
    for byte in stream:
        acc, n = acc | byte << n, n + 8
        while n >= width:
            code, acc, n = acc & ((1 << width) - 1), acc >> width, n - width
            if code == clear:
                table, width, before = [bytes([i]) for i in range(clear)] + [b"", b""], bits + 1, None
                continue
            if code == clear + 1:
                return bytes(out)
            now = table[code] if code < len(table) else before + before[:1]
            if before is not None and len(table) < 4096:
                table.append(before + now[:1])
                width += len(table) == 1 << width and width < 12
            out += now
            before = now
    return bytes(out)


def test_lzw_both_ways():
    rng = random.Random(1)
    for data in [b"", b"a", b"aaaa" * 4000, rng.randbytes(20_000), bytes(50_000), fixtures.prose(rng, 5000).encode()]:
        stream = media.lzw_encode(data)
        assert slow_lzw(stream, 8) == data and media.lzw_decode(stream, 8).tobytes() == data


def test_frames_disposal_and_transparency():
    one, two = np.zeros((4, 6), np.uint8), np.full((4, 6), 9, np.uint8)
    two[0, 0] = 7
    gif = media.encode_gif([one, two, one], media.GREY, delay_ms=50, disposal=1, transparent=9)
    a, b, c = media.decode_gif(gif)
    assert [f.delay_ms for f in (a, b, c)] == [50, 50, 50]
    assert b.canvas[0, 0].tolist() == [7, 7, 7, 255] and b.canvas[1, 1].tolist() == [0, 0, 0, 255]
    wiped = list(media.decode_gif(media.encode_gif([one, two], media.GREY, disposal=2, transparent=9)))
    assert wiped[1].canvas[1, 1].tolist() == [0, 0, 0, 0] and wiped[1].histogram().sum() == 3
    back = list(media.decode_gif(media.encode_gif([one, two, np.full((4, 6), 9, np.uint8)], media.GREY, disposal=3, transparent=9)))
    assert back[2].canvas[0, 0].tolist() == [0, 0, 0, 0]
    assert list(media.decode_gif(b"nothing")) == [] and list(media.decode_gif(gif[:13])) == []


def test_damaged_gifs():
    """A header that asks for 16 GB is damage, and so are cut or altered code streams; what stands before is read."""
    assert list(media.decode_gif(b"GIF89a" + b"\xff\xff\xff\xff\x80\0\0" + bytes(6))) == []
    gif = media.store_bytes(bytes(range(256)) * 300)
    rng = random.Random(2)
    for _ in range(60):
        cut = bytearray(gif[: rng.randrange(len(gif))])
        for _ in range(rng.randrange(4)):
            if len(cut) > 800:
                cut[rng.randrange(790, len(cut))] = rng.randrange(256)
        assert len(list(media.decode_gif(bytes(cut)))) <= 3


def test_media(spark, docs, texts, none, unkeyed):
    for r in media.media_columns(docs).collect():
        raw = (texts[r.doc_id] or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        gif = media.store_bytes(payload)
        assert (r.media_bytes, r.media_sha256) == (len(gif), hashlib.sha256(gif).hexdigest())
    assert media.media_columns(none).count() == 0 and media.media_columns(unkeyed).count() == 4


def test_frame_rows(spark):
    gif = media.store_bytes(bytes(range(256)) * 256)
    got = media.frame_rows(spark.createDataFrame([(1, bytearray(gif)), (2, None), (3, bytearray(b"no"))], "k long, gif binary"), "k", "gif").orderBy("frame").collect()
    assert [(r.k, r.frame, r.width, r.height, sum(r.red)) for r in got] == [(1, 0, 64, 512, 64 * 512), (1, 1, 64, 512, 64 * 512)]


# ---- 4 and 5: tokens ----


def odd_strings():
    rng = random.Random(1)
    alphabet = "aAbz \n\t  \r\x1c\x85\xa0'’s<|>é̈ÀßΣİ日本1234.,!?😀ﬁ\x00"
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    return out + ["x" * 5000, "ab" * 3000, "日本語" * 1000, "".join(rng.choice("abcdefgHIJ0123+/") for _ in range(20_000)), "<|endoftext|>", "a<|endoftext|>b <|startoftext|> x", "I'LL don't ΣΑΣ", "=-" * 3000]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_same_ids_as_the_library(name, texts):
    own, lib = bpe.Codec(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
    for t in [*odd_strings(), *(t for t in texts.values() if t)]:
        want = lib.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(own.ids(t), "<u4").tolist() == want
        if name.startswith("byte"):
            assert own.text(own.ids(t)) == lib.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_slices_of_a_text_change_nothing(name, texts, monkeypatch):
    own = bpe.Codec(tokenizer_path(name))
    odd = [" a  b c", "x \u0301y \x1c z", "a \n b c ", "I 'll  go 12 34", " ", "", "\u00a0 a b\u3000 c", "a <|endoftext|> b c d"]
    whole = [own.ids(t) for t in [*texts.values(), *odd]]
    for n in (1, 2, 5, 40):
        monkeypatch.setattr(bpe, "SLICE_CHARS", n)
        assert [own.ids(t) for t in [*texts.values(), *odd]] == whole


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_every_token_is_what_its_merges_give(name):
    """With that, merging by the rank of the result, as the codec does, equals merging by the file's list of pairs."""
    with open(tokenizer_path(name), encoding="utf-8") as f:
        model = json.load(f)["model"]
    rank = {(a, b): k for k, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"])}
    end = model.get("end_of_word_suffix") or ""
    for token in model["vocab"]:
        if token.startswith("<|"):
            continue
        closed = end and token.endswith(end)
        parts = list(token[: -len(end)] if closed else token)
        if closed:
            parts[-1] += end
        while len(parts) > 1:
            low, k = min((rank.get(pair, 1 << 60), k) for k, pair in enumerate(zip(parts, parts[1:], strict=False)))
            assert low < 1 << 60, token
            parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_tree_joins_at_any_leaf():
    own = bpe.Codec(tokenizer_path("byte_bpe_50k.json"))
    rng = random.Random(3)
    for _ in range(60):
        piece = "".join(rng.choice("esntari") for _ in range(rng.randint(1, 900))).encode()
        assert bpe.encode_tree(piece, own.core.encode_single_piece, own.piece_bytes, leaf=rng.randint(1, 40)) == own.core.encode_single_piece(piece)


def test_bpe_columns(spark, docs, texts, none, unkeyed):
    path = tokenizer_path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    for r in bpe.encode_decode(docs, path).collect():
        ids = lib.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    assert bpe.encode_decode(none, path).count() == 0 and bpe.encode_decode(unkeyed, path).count() == 4


def test_token_files(spark, docs, rows, none, unkeyed):
    path, lib = tokenizer_path("word_bpe_49k.json"), Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    own = docs.dropDuplicates(["doc_id"])
    files = tokenfile.write(own, path, to := f"{shared_dir(spark)}/t1")
    got, at = {r.doc_id: r for r in tokenfile.read(spark, to).collect()}, 0
    for doc, text in sorted({(r[0], r[1]) for r in rows}, key=lambda r: r[0]):
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 2]
        assert tuple(got[doc]) == (doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert tokenfile.fetch(spark, to, 3) == [[*lib.encode(rows[3][1], add_special_tokens=False).ids, 2]]
    assert tokenfile.TokenFiles.open(spark, to).sha256 == files.sha256
    tokenfile.write(none, path, e := f"{shared_dir(spark)}/t2")
    assert tokenfile.read(spark, e).count() == 0
    tokenfile.write(unkeyed, path, n := f"{shared_dir(spark)}/t3")
    assert sorted(r.start for r in tokenfile.read(spark, n).collect())[0] == 0 and tokenfile.read(spark, n).count() == 4


# ---- 6: packing ----


def check_packing(rows, total, room):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= room
    assert sum(r.length for r in rows) == total
    return len(bins)


def test_best_fit_matches_one_by_one():
    rng = random.Random(5)
    for _ in range(30):
        counts = Counter(rng.randint(1, 60) for _ in range(rng.randint(1, 80)))
        free = []
        for size in sorted(counts.elements(), reverse=True):
            fits = [f for f in free if f >= size]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - size)
            else:
                free.append(60 - size)
        assert packing.best_fit(counts, 60).total() == len(free)


def test_local_search_keeps_all_and_helps():
    rng = random.Random(6)
    fewer = 0
    for _ in range(40):
        counts = Counter(rng.randint(15, 45) for _ in range(60))
        first = packing.best_fit(counts, 100)
        after = packing.local_search(first, 100)
        assert sum((Counter({s: n * c for s, c in Counter(p).items()}) for p, n in after.items()), Counter()) == counts
        assert all(sum(p) <= 100 for p in after) and after.total() <= first.total()
        fewer += after.total() < first.total()
    bad = Counter({(60, 20): 1, (50, 30): 1, (40,): 1})
    assert packing.local_search(bad, 100).total() == 2 and fewer > 0


def test_local_search_empties_sequences():
    """Threes that fill a sequence exactly: best fit leaves many sequences half empty, and the search empties at least a twentieth."""
    before = after = 0
    for seed in range(3):
        rng, counts = random.Random(seed), Counter()
        for _ in range(30):
            a = rng.randint(250, 500)
            b = rng.randint(250, min(500, 750 - a))
            counts.update([a, b, 1000 - a - b])
        first = packing.best_fit(counts, 1000)
        found = packing.local_search(first, 1000)
        assert sum((Counter({s: n * c for s, c in Counter(p).items()}) for p, n in found.items()), Counter()) == counts and all(sum(p) <= 1000 for p in found)
        before, after = before + first.total(), after + found.total()
    assert 90 <= after <= 0.95 * before


def test_local_search_without_short_documents():
    """No exchange is left that raises the squared fill, by trying them all; thousands of pieces take seconds."""
    rng = random.Random(8)
    counts = Counter(rng.randint(600, 1600) for _ in range(2000))
    first = packing.best_fit(counts, 4096)
    found = packing.local_search(first, 4096)
    assert found.total() < first.total()
    counts = Counter(rng.randint(20, 45) for _ in range(60))
    found = packing.local_search(packing.best_fit(counts, 100), 100)
    if found.total() > -(-sum(s * n for s, n in counts.items()) // 100):
        under = [p for p in found.elements() if sum(p) < 100]
        for i, a in enumerate(under):
            for k, b in enumerate(under):
                if i != k and sum(b) >= sum(a):
                    gives = [(x, 0) for x in a] + [(x, y) for x in a for y in b] + [(a[p] + a[q], y) for p in range(len(a)) for q in range(p) for y in b]
                    assert not any(0 < x - y <= 100 - sum(b) for x, y in gives)


def test_packing_of_a_hot_length(spark):
    """Two thirds of the pieces have one length, among them full ones: ranks come from many cells, offsets are gapless."""
    rows = [(k, 0, 0, 4096 if k % 3 else 1000 + k % 50, 0) for k in range(9000)]
    got = packing.pack(spark.createDataFrame(rows, packing.PIECES)).collect()
    check_packing(got, sum(r[3] for r in rows), 4096)
    assert len(got) == 9000 and len({(r.sequence_id, r.offset) for r in got}) == 9000


def test_packing(spark, docs, rows, none, unkeyed):
    path = tokenizer_path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    got = packing.pack(packing.pieces_of(docs, path, 1)).collect()
    total = sum(1 + len(lib.encode(r[1] or "", add_special_tokens=False).ids) for r in rows)
    assert check_packing(got, total, 4096) <= -(-total // 4096) + 1
    ids = [*lib.encode(rows[3][1], add_special_tokens=False).ids, 1]
    own = next(r for r in got if r.doc_id == 3)
    assert (own.piece, own.start, own.length, own.ids_crc32) == (0, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    long = next(k for k, r in enumerate(rows) if r[1] and len(r[1]) > 12_000)
    assert len([r for r in got if r.doc_id == long]) > 1
    assert packing.pack(packing.pieces_of(none, path, 1)).count() == 0 and packing.pack(packing.pieces_of(unkeyed, path, 1)).count() == 4


# ---- 7: passages ----


def removed(df, text="text"):
    out = []
    for r in df.collect():
        raw = (r[text] or "").encode()
        spans = passages.spans_of(r._runs and [{"lo": x.lo, "runs": [y.asDict() for y in x.runs]} for x in r._runs], 400)
        out.append((r.doc_id, passages.keep(raw, spans), len(spans)))
    return sorted(out)


@pytest.mark.parametrize("most", [1000, 0])
def test_passages_against_brute_force(spark, docs, rows, most):
    """With ``most`` 0 every shared key takes the counted way."""
    want = fixtures.without_passages([r[1] for r in rows])
    assert removed(passages.with_repeats(docs, most=most)) == sorted((r[0], *w) for r, w in zip(rows, want, strict=True))


def test_passages_hot(spark):
    rng = random.Random(9)
    common = fixtures.prose(rng, 130)
    data = [(k, fixtures.prose(rng, rng.randint(5, 60)) + common + fixtures.prose(rng, rng.randint(5, 60))) for k in range(60)]
    want = fixtures.without_passages([t for _, t in data])
    for most in (10, 1000):
        assert removed(passages.with_repeats(spark.createDataFrame(data, "doc_id long, text string"), most=most)) == [(k, *w) for (k, _), w in zip(data, want, strict=True)]


def test_passages_cases(spark, docs, none, unkeyed):
    assert passages.remove_passages(docs).columns == docs.columns
    assert passages.remove_passages(none).count() == 0 and passages.remove_passages(unkeyed).count() == 4
    with pytest.raises(ValueError):
        passages.with_repeats(docs, length=410)


def without_words(texts, n=50):
    """Texts without the bytes of 400-byte strings and of strings of ``n`` words that start elsewhere too, by brute force."""
    raws = [(t or "").encode() for t in texts]
    places = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", r)] for r in raws]
    strings = [[tuple(r[a:b] for a, b in p[i : i + n]) for i in range(len(p) - n + 1)] for r, p in zip(raws, places, strict=True)]
    seen = Counter(x for own in strings for x in own)
    seen_bytes = Counter(r[i : i + 400] for r in raws for i in range(len(r) - 399))
    out = []
    for r, p, own in zip(raws, places, strings, strict=True):
        gone = bytearray(len(r))
        for i, x in enumerate(own):
            if seen[x] > 1:
                a, b = p[i][0], p[i + n - 1][1]
                gone[a:b] = b"\1" * (b - a)
        for i in range(len(r) - 399):
            if seen_bytes[r[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        out.append(bytes(b for b, g in zip(r, gone, strict=True) if not g).decode("utf-8", "ignore"))
    return out


def word_passages(seed=5):
    """Documents that share passages of 49 to 70 short words, under 400 bytes, in any wording of blanks."""
    rng = random.Random(seed)
    words = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(n)]
    shared = [words(n) for n in (49, 50, 51, 58, 70)]
    data = []
    for k in range(40):
        own = [*words(rng.randint(0, 90)), *shared[k % 5], *words(rng.randint(0, 90))]
        data.append((k, rng.choice([" ", "\n", " \t "]).join(own)))
    data += [(40, "and " * 78), (41, " ".join(words(300))), (42, None), (43, ""), (44, " ".join(words(49))), (None, " ".join(shared[3])), (2, " ".join([*words(9), *shared[4]]))]
    assert all(len(" ".join(s)) < 400 for s in shared)
    return data


@pytest.mark.parametrize("most", [1000, 3, 0])
def test_passages_of_words_under_400_bytes(spark, rows, most, monkeypatch):
    """op7's operator: the same by the transforms and by the counted way, and on the odd documents."""
    whole = passages.with_repeats
    monkeypatch.setattr(passages, "with_repeats", lambda *a, **b: whole(*a, **b, most=most))
    for data in (word_passages(), [(r[0], r[1]) for r in rows]):
        want = without_words([t for _, t in data])
        got = passages.remove_passages(spark.createDataFrame(data, "doc_id long, text string"), words=50).collect()
        assert sorted(((r.doc_id, r.text or "") for r in got), key=str) == sorted(((k, w) for (k, _), w in zip(data, want, strict=True)), key=str)


def test_merged_transform_is_the_suffix_order():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(40, 300))).encode() * rng.randint(1, 2) for _ in range(9)]
    s, merged = bwt.repeated(texts, 3, shard_bytes=400)
    own = {}
    for node, interval in zip(merged.node.tolist(), merged.interval.tolist(), strict=True):
        text, place = texts[s.text[node]], s.place[node]
        if place + 120 <= len(text):
            own.setdefault(interval, set()).add(text[place : place + 120])
    assert all(len(x) == 1 for x in own.values()) and len({next(iter(x)) for x in own.values()}) == len(own)
    assert sorted(merged.node.tolist()) == list(range(len(s.rank)))
    same_interval = merged.interval[1:] == merged.interval[:-1]
    assert (merged.lcp[1:][same_interval] == 3).all() and (merged.lcp[1:][~same_interval] < 3).all()


# ---- 8: sharding ----


@pytest.mark.parametrize("n", [0, 1, 15, 16, 1000])
def test_rows_law(spark, n):
    got = sharding.shard_rows(spark.range(n).toDF("doc_id"), "doc_id", 16, cells=64).toPandas()
    sizes = got.groupby("shard").slot.agg(["count", "min", "max", "nunique"]) if n else []
    assert len(got) == n
    if n:
        counts = sizes["count"].reindex(range(16), fill_value=0)
        assert counts.max() - counts.min() <= 1 and (sizes["min"] == 0).all() and (sizes["max"] + 1 == sizes["count"]).all() and (sizes["nunique"] == sizes["count"]).all()


def test_ring_by_walking():
    """Ranges agree with putting each key by itself, and most keys stay with the first shard clockwise."""
    rng = random.Random(2)
    counts = Counter(rng.randrange(64) for _ in range(500))
    ranges = sharding.assign_ranges(dict(counts), 5, 8, 64)
    place, owner = {}, {}
    for cell, first, end, shard, _ in ranges:
        place.update({(cell, r): shard for r in range(first, end)})
    points, load = sharding.ring_points(5, 8, 64), Counter()
    free, over = Counter({s: 100 for s in range(5)}), []
    at = lambda c: next((k for k, p in enumerate(points) if p[0] >= c), 0)
    for cell in sorted(counts):
        for r in range(counts[cell]):
            s = points[at(cell)][1]
            if free[s]:
                free[s] -= 1
                owner[(cell, r)] = s
            else:
                over.append((cell, r))
    for cell, r in over:
        k = at(cell)
        while not free[points[k % len(points)][1]]:
            k += 1
        free[points[k % len(points)][1]] -= 1
        owner[(cell, r)] = points[k % len(points)][1]
    load.update(place.values())
    assert place == owner and set(load.values()) == {100} and len(over) < 250


def test_sharding_cases(spark, docs, rows, none, unkeyed):
    got = sharding.shard_rows(docs, "doc_id", 4, tie="text").toPandas()
    assert len(got) == len(rows) and set(got.shard) == {0, 1, 2, 3} and got.groupby("shard").size().max() - got.groupby("shard").size().min() <= 1
    assert sharding.shard_rows(none, "doc_id").count() == 0 and sharding.shard_rows(unkeyed, "doc_id").count() == 4


# ---- 9: near duplicates ----


def test_near_groups(spark, docs, rows, none, unkeyed):
    want = fixtures.near_components([(r[0], r[1]) for r in rows])
    got = neardup.near_groups(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)
    assert neardup.near_groups(none).count() == 0
    assert {(r.doc_id, r.component_id, r.kept) for r in neardup.near_groups(unkeyed).collect()} == {(None, None, True), (1, 1, True)}


def test_near_groups_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = fixtures.near_components([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.op9_neardup(spark, sf_dir).collect()} == want


@pytest.mark.parametrize("words", range(7))
def test_near_groups_of_few_words(spark, words):
    """A partition with 0 to 6 words in all."""
    text = " ".join("abcdefg"[:words])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_groups(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string").coalesce(1)).collect()}
    assert got == {d: (max(min(words, 1), words - 4), 1 if words else d) for d in (1, 2)}
    assert [len(s) for s in neardup.shingle_sets([b"a", b"b c"])] == [1, 1]


def test_near_groups_of_repeated_keys(spark):
    rng = random.Random(2)
    a, b = fixtures.prose(rng, 80), fixtures.prose(rng, 80)
    got = {(r.doc_id, r.th): (r.component_id, r.first) for r in neardup.near_groups(spark.createDataFrame([(5, a), (7, a + " x"), (7, b), (9, b + " y")], "doc_id long, text string")).collect()}
    assert sorted((k[0], *v) for k, v in got.items()) == [(5, 5, True), (7, 5, False), (7, 7, True), (9, 7, False)]


def test_large_region_is_found_through_neighbours():
    """A stretch of hundreds of equal prefixes gives a number of pairs that grows with the rows, not their square."""
    n = 300
    label = np.zeros((n, neardup.SLOT * neardup.DEPTH), np.uint8)
    label[:, -1] = np.arange(n) % 251
    a, b, _ = neardup._pairs_in_order(np.zeros(n, int), label, np.arange(n), np.zeros((n, 16), np.uint8), 0)
    assert len(a) <= (neardup.NEIGHBOURS + 1) * n and set(a) | set(b) == set(range(n))


def test_links_in_a_dense_region(spark, monkeypatch):
    """Texts around one template, all pairs just under the threshold but for a few planted ones, against brute force."""
    rng = random.Random(5)
    template = [f"t{i}" for i in range(200)]
    partners = rng.sample(range(300), 50)
    rows = []
    for k in range(400):
        words = list(template)
        for place in range(6):
            words[20 + 30 * place] = f"own{k}x{place}"
        if k >= 350:  # one word in common with an earlier text
            words[20] = rows[partners[k - 350]][1].split(" ")[20]
        rows.append((k, " ".join(words)))
    sets = [fixtures.shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    for j in range(len(rows)):
        for i in range(j):
            both = len(sets[i] & sets[j])
            if 4 * both >= 3 * (len(sets[i]) + len(sets[j]) - both):
                root = [root[i] if r == root[j] else r for r in root]
    assert len(set(root)) == 350
    monkeypatch.setattr(neardup, "BLOCK", 64, raising=False)
    got = {r.doc_id: r.component_id for r in neardup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(root))


# ---- 2 and 10: what SQL does not say ----


def test_quality_cases(spark, docs, rows, none, unkeyed):
    got = quality.quality_columns(docs).select("doc_id", "text", "n_words", "base_failed", "kept").collect()
    assert len(got) == len(rows)
    assert all(r.base_failed and not r.kept for r in got if not (r.text or "").strip())
    assert quality.clean_documents(docs).columns == docs.columns
    assert quality.quality_columns(none).count() == 0 and quality.quality_columns(unkeyed).count() == 4


def test_quality_rules(spark):
    lines = ["Home | About | Contact", "We use cookies to make this better.", "click here", "A full sentence that stays.", "### *** ###", "", "Login"]
    got = spark.createDataFrame([("\n".join(lines),)], "text string").select(quality.clean_lines(F.col("text"))).first()[0]
    assert got == ["A full sentence that stays."]


def test_words_after_a_long_one_count(spark):
    lines = ["x" * 500 + " and then some words", " " * 400 + "five words after many blanks", "x" * 500 + " three words left"]
    got = spark.createDataFrame([("\n".join(lines),)], "text string").select(quality.clean_lines(F.col("text"))).first()[0]
    assert got == lines[:2]


def test_lines_against_brute_force(spark, docs, rows, none, unkeyed):
    want = fixtures.dropped_lines([(r[0], r[1]) for r in rows])
    got = {(r.doc_id, r.line): r.exact for r in linededup.dropped_lines(docs).collect()}
    assert got == want and len(want) > 40
    assert linededup.dedup_lines(docs).columns == docs.columns
    assert linededup.dedup_lines(none).count() == 0 and linededup.dedup_lines(unkeyed).count() == 4


def test_line_edits(spark):
    base = "one two three four five six seven"
    data = [(0, base), (1, base.replace("four", "vier")), (2, base + " eight"), (3, "two three four five six seven eight"), (4, "one two five"), (5, "one two six")]
    got = {r.doc_id for r in linededup.dropped_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {1, 2, 3}


@pytest.mark.parametrize("n", [5, 6, 7, 15, 16, 17, 18, 33, 60, 400])
def test_line_edits_at_any_length(spark, n):
    """One word replaced, inserted or removed anywhere is near from 6 words on; two are not."""
    data = []
    for k, place in enumerate((0, 1, n // 2 - 1, n // 2, n // 2 + 1, n - 1)):
        words = [f"w{k}x{i}" for i in range(n)]
        data += [(10 * k, words), (10 * k + 1, [*words[:place], "new", *words[place + 1 :]]), (10 * k + 2, [*words[:place], "put", *words[place:]])]
        data += [(10 * k + 3, [*words[:place], *words[place + 1 :]])]
    far = [f"far{i}" for i in range(n)]
    data += [(100, far), (101, ["a", *far[1:-1], "z"]), (102, ["a", *far, "z"])]
    got = {r.doc_id for r in linededup.dropped_lines(spark.createDataFrame([(d, " ".join(w)) for d, w in data], "doc_id long, text string")).collect()}
    rows = {d: w for d, w in data}
    want = {d for d, w in data if len(w) >= 6 and any(e < d and len(rows[e]) >= 6 and fixtures._close(w, rows[e]) for e in rows)}
    assert got == want and (n < 6 or {1, 2, 11, 12, 51, 52} <= got) and not {100, 101, 102} & got


def test_lines_of_rows_that_repeat_a_key(spark):
    lone = "a wholly unique sentence that stands nowhere else."
    data = [(5, "one line that stands in two documents here."), (7, "one line that stands in two documents here."), (7, lone), (None, "something else that has no key and no twin."), (None, "another one of the rows without a key here."), (8, lone)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in linededup.dedup_lines(docs).collect()), key=str)
    assert got == sorted([data[0], data[2], data[3], data[4]], key=str)


def test_lines_that_differ_in_blanks(spark):
    """Many spellings of one line, and lines with one word more: a pair for each row, and all but the earliest go."""
    words = [f"w{i}" for i in range(12)]
    data = [(k, (" " * (k + 1)).join(words)) for k in range(30)] + [(100 + k, " ".join([*words, f"more{k}"])) for k in range(30)]
    got = {r.doc_id for r in linededup.dropped_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == set(range(1, 30)) | set(range(100, 130))


def test_boilerplate_in_lines_of_any_length(spark):
    lines = ["We use cookies here. " + "plain words " * k + "." for k in (1, 20, 30, 4000)] + ["plain words " * k + "." for k in (3, 4000)]
    got = spark.createDataFrame([("\n".join(lines),)], "text string").select(quality.clean_lines(F.col("text"))).first()[0]
    assert got == lines[4:]

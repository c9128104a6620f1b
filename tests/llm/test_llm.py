"""The training-data operators against brute force, round trips and awkward rows."""

from __future__ import annotations

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import byte_bpe, common, extraction, licences, near_dups, neighbours, packing, passages, quality, sharding, token_files

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a\x1cb  İx<|endoftext|> it's　ü̈"), (5, "x " * 30000), (6, "same text here"), (7, "same text here"), (7, "same text here"), (None, "no id")]
EMPTY = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def odd(spark):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in ODD], "doc_id long, text string, hash string, shard int, node string")


def test_token_files(spark, docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    path = common.scratch(spark, "t")
    manifest = token_files.write_token_files(docs, P.path("word_bpe_49k.json"), path)
    rows = {r.doc_id: r for r in token_files.read_token_files(manifest).collect()}
    start = 0
    for i in sorted(texts):
        ids = tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [1]
        r = rows[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    some = token_files.fetch_documents(manifest, [3, 17, 10**9]).collect()
    assert {r.doc_id: r.ids for r in some} == {i: tokenizer.encode(texts[i], add_special_tokens=False).ids + [1] for i in (3, 17)}
    first = manifest.orderBy("part").first().file
    local = first.removeprefix("file://")
    raw = bytearray(open(local, "rb").read())
    raw[6] ^= 1
    with pytest.raises(Exception):  # noqa: B017 a broken frame is told by zstandard or by the checksum
        import pyarrow as pa

        reader = token_files.FrameReader(pa.BufferReader(bytes(raw)))
        reader.document(0)


def test_token_files_odd(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for data, n in ((odd(spark), len(ODD)), (spark.createDataFrame([], EMPTY), 0)):
        manifest = token_files.write_token_files(data, P.path("word_bpe_49k.json"), common.scratch(spark, "t"))
        rows = token_files.read_token_files(manifest).collect()
        assert len(rows) == n
        if n:
            want = sorted((i is not None, i or 0, len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in ODD)
            assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens) for r in rows) == want


def _odd_texts(n: int, seed: int) -> list[str]:
    """Texts of letters, marks, signs and spaces from all over Unicode, with special strings and stops after letters."""
    rng = np.random.default_rng(seed)
    pieces = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", ",", ".", ", ", ". ", " ", "\n", "0", "İ", "I\u0307", "ß", "e\u0301", "'s", "it's", "ALİ, ", "Σ.", "Ǆ,"]
    ranges = [(0x20, 0x7F), (0xA0, 0x250), (0x300, 0x370), (0x370, 0x530), (0x530, 0x1100), (0x1E00, 0x2100), (0x4E00, 0x4F00), (0xA640, 0xA7FF), (0x10280, 0x10400), (0x1F300, 0x1F700)]
    out = []
    for _ in range(n):
        text = ""
        for _ in range(int(rng.integers(1, 25))):
            low, high = ranges[rng.integers(len(ranges))]
            text += pieces[rng.integers(len(pieces))] if rng.random() < 0.5 else chr(rng.integers(low, high))
        out.append(text)
    return out


def test_ids_are_those_of_the_library_with_its_own_settings():
    from tokenizers import Tokenizer

    texts = _odd_texts(6000, 5) + ["ALİ, geldi", "a<|endoftext|>b", " <|endoftext|> x", "x<|endoftext|>,", "<|endoftext|>"]
    words = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    encoder = token_files.WordEncoder(P.path("word_bpe_49k.json"))
    kind = f"<u{encoder.width}"
    for text, raw in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(raw, kind).tolist() == words.encode(text, add_special_tokens=False).ids, text
    pairs = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    encode = packing.rank_encoding(P.path("byte_bpe_50k.tiktoken")).encode
    for text in texts:
        assert encode(text, allowed_special={packing.END_TEXT}, disallowed_special=()) == pairs.encode(text, add_special_tokens=False).ids, text


def test_packing(spark, docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
    rows = packing.pack_documents(docs, P.path("byte_bpe_50k.tiktoken")).collect()
    covered, filled = Counter(), Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        filled[r.sequence_id] += r.length
        covered[r.doc_id] += r.length
    assert covered == Counter({i: len(a) for i, a in ids.items()})
    assert all(n <= 2048 and (n == 2048 or n & (n - 1) == 0) for n in filled.values())


def test_closest_is_the_best_sum():
    rng = np.random.default_rng(3)
    for _ in range(50):
        lengths = rng.integers(1, 60, 9).tolist()
        target = int(rng.integers(1, 150))
        best = max(s for m in range(1 << 9) if (s := sum(x for i, x in enumerate(lengths) if m >> i & 1)) <= target)
        counts = sorted(Counter(lengths).items(), reverse=True)
        chosen = packing.closest(target, counts)
        assert sum(length * k for length, k in chosen) == best
        assert all(k <= Counter(lengths)[length] for length, k in chosen)


def test_packing_odd(spark):
    assert packing.pack_documents(spark.createDataFrame([], EMPTY), P.path("byte_bpe_50k.tiktoken")).count() == 0
    rows = packing.pack_documents(odd(spark), P.path("byte_bpe_50k.tiktoken")).collect()
    assert sum(r.length for r in rows if r.doc_id in (1, 2)) == 2 and sum(r.start == 0 for r in rows) == len(ODD)


def jump(key, n):
    key, b, j = key & (2**64 - 1), -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_sharding(spark, docs, texts):
    rows = sharding.shard_documents(docs).collect()
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (jump(r.doc_id, 16), jump(r.doc_id, 17))
        assert r.grown_shard in (r.shard, 16)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    keys = spark.createDataFrame([(-5,), (2**62 + 12345,), (-(2**63),), (10**15,)], "k long")
    assert [(r.a, r.b) for r in keys.select(sharding.jump_hash(F.col("k"), 16).alias("a"), sharding.jump_hash(F.col("k"), 1000).alias("b")).collect()] == [(jump(k, 16), jump(k, 1000)) for k in (-5, 2**62 + 12345, -(2**63), 10**15)]
    assert sharding.shard_documents(odd(spark)).count() == len(ODD)
    assert sharding.shard_documents(spark.createDataFrame([], EMPTY)).count() == 0


def test_byte_bpe(spark, docs, texts):
    encoding = packing.rank_encoding(P.path("byte_bpe_multi_50k.tiktoken"))
    for data, want in ((docs, list(texts.items())), (odd(spark), ODD), (spark.createDataFrame([], EMPTY), [])):
        rows = byte_bpe.encode_documents(data, P.path("byte_bpe_multi_50k.tiktoken"), owners=5, block_chars=40_000).collect()
        expected = []
        for i, t in want:
            ids = encoding.encode_ordinary(t or "")
            assert encoding.decode_bytes(ids) == (t or "").encode()
            expected.append((i or -1, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
        assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(expected)


def test_extraction(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    import html

    def truth(page):
        body = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        return " ".join(html.unescape(re.sub(r"<[^>]+>", lambda m: "" if m.group() in ("<b>", "</b>") else " ", body)).split())

    found = {r.page_id: r for r in extraction.extract(pages).collect()}
    for r in pages.collect():
        assert found[r.page_id].text == truth(r.html) and found[r.page_id].n_chars == len(found[r.page_id].text)
    article = "<div id='x'><h1>A title</h1><p>One two three &amp; four<br>five six seven eight.</p><blockquote>Quoted words are here</blockquote><ul><li>first item</li></ul></div>"
    page = f"<body><div class='menu'><a href='/'>Home</a> <a>More</a></div>{article}<section id='comments'><p>reader says something quite long here</p></section><form>Send<input></form><aside>Also read</aside></body>"
    odd_pages = spark.createDataFrame([(1, None, None), (2, "u", ""), (3, "u", "<p>"), (4, "u", page), (5, None, "< not a tag & text")], "page_id long, url string, html string")
    rows = {r.page_id: r.text for r in extraction.extract(odd_pages).collect()}
    assert rows[1] == rows[2] == rows[3] == "" and rows[5] == "< not a tag & text"
    assert rows[4] == "A title One two three & four five six seven eight. Quoted words are here first item"
    assert extraction.extract(odd_pages.limit(0)).count() == 0


def test_quality(spark, docs, texts):
    rows = {r.doc_id: r for r in quality.judge(docs, P.path("piece_bpe_32k.model")).collect()}
    for i, t in texts.items():
        words, seen, dup = WORD.findall(t or ""), set(), 0
        grams = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        cover = {k + x for k in range(len(words) - 4) if grams[tuple(words[k : k + 5])] > 1 for x in range(5)}
        for line in (t or "").split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        failed = len(words) < 10 or 100 * len(cover) > 20 * len(words)
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(cover), failed)
        assert not (r.kept and failed)
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    judged = [rows[i].kept for i in good if not rows[i].base_failed]
    assert np.mean(judged) >= 0.98
    assert [r.kept for r in quality.judge(odd(spark), P.path("piece_bpe_32k.model")).collect()].count(True) == 0
    assert quality.judge(spark.createDataFrame([], EMPTY), P.path("piece_bpe_32k.model")).count() == 0


def test_fertility_bands_find_symbol_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = quality.judge(docs, P.path("piece_bpe_32k.model")).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept for r in rows if r.quality == 1]) >= 0.98
    assert np.mean([r.kept for r in rows if r.quality == 0]) <= 0.3


def test_fertility_bands_take_few_shuffles_and_no_cross_join(spark, docs, monkeypatch):
    plans, written = [], common.written

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, name)

    monkeypatch.setattr(quality, "written", seen)
    plans.append(quality.judge(docs, P.path("piece_bpe_32k.model"))._jdf.queryExecution().executedPlan().toString())
    assert not any(x in plan for plan in plans for x in ("CartesianProduct", "NestedLoop"))
    assert sum(plan.count("Exchange hashpartitioning") for plan in plans) <= 6


def test_fertility_judges_a_document_alone_in_its_length_class(spark, docs):
    rng = np.random.default_rng(3)
    rare = " ".join("".join(chr(int(c)) for c in rng.integers(0x12000, 0x12300, 4)) for _ in range(30000))
    alone = spark.createDataFrame([(10**6, rare, "xx"), (10**6 + 1, rare, "en")], "doc_id long, text string, lang string")
    rows = quality.judge(docs.select("doc_id", "text", "lang").union(alone), P.path("piece_bpe_32k.model")).where("doc_id >= 1000000").collect()
    assert [(r.base_failed, r.kept) for r in rows] == [(False, False)] * 2
    only = quality.judge(alone, P.path("piece_bpe_32k.model")).collect()
    assert [(r.base_failed, r.kept) for r in only] == [(False, False)] * 2


def test_prob_min_hash_estimates():
    rng = np.random.default_rng(5)
    a, b = (np.sort(rng.choice(2**40, 300, replace=False).astype(np.uint64)) for _ in range(2))
    b = np.sort(np.concatenate((a[:250], b[:60])))
    wa, wb = rng.integers(1, 5, len(a)).astype(float), rng.integers(1, 5, len(b)).astype(float)
    sig = near_dups.prob_min_hash(np.repeat([0, 1], [len(a), len(b)]), np.concatenate((a, b)), np.concatenate((wa, wb)), 2, 4096)
    pa, pb = dict(zip(a, wa, strict=True)), dict(zip(b, wb, strict=True))
    exact = sum(1 / sum(max(pa.get(e, 0) / pa[d], pb.get(e, 0) / pb[d]) for e in pa.keys() | pb.keys()) for d in pa.keys() & pb.keys())
    assert abs(near_dups.similarity((a, wa), (b, wb)) - exact) < 1e-9
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.04


def near_docs(spark):
    rng = np.random.default_rng(9)
    rows = []
    for group in range(4):
        base = [f"w{group}_{x}" for x in rng.integers(0, 10**6, 120)]
        for copy in range(30):
            words = list(base)
            for at in rng.choice(120, rng.integers(0, 9), replace=False):
                words[at] = f"e{rng.integers(10**6)}"
            rows.append((len(rows), " ".join(words)))
    return spark.createDataFrame(rows + [(900, "a b c"), (901, "a b c"), (902, None), (903, ""), (904, ""), (3, rows[3][1])], EMPTY)


def test_near_duplicates_match_brute_force(spark):
    docs = near_docs(spark)
    found = {r.doc_id: r.class_id for r in near_dups.classes(docs).collect()}
    texts = {r.doc_id: WORD.findall(r.text or "") for r in docs.collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, w in texts.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert found == {i: root(i) for i in sets}
    assert near_dups.classes(docs.limit(0)).count() == 0


def test_between_blocks_finds_every_bridge(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 7)
    test_near_duplicates_match_brute_force(spark)


def test_passages(spark, docs, texts):
    rows = passages.passages(docs).collect()
    spans, words = {}, {i: WORD.findall(t or "") for i, t in texts.items()}
    for r in rows:
        spans.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
        assert r.source_id < r.doc_id and r.n_words == r.end_word - r.start_word >= 50
    first, run = {}, 20
    for i in sorted(words):
        hit = np.zeros(len(words[i]), bool)
        for k in range(len(words[i]) - run + 1):
            if first.setdefault(tuple(words[i][k : k + run]), i) != i:
                hit[k : k + run] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(int), [0]))))
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            if b - a >= 50:
                assert any(x <= a + 3 and y >= b - 3 for x, y in spans.get(i, [])), (i, a, b)


def test_passages_planted_fuzzy_and_odd(spark):
    rng = np.random.default_rng(2)
    fresh = lambda n: [f"q{x}" for x in rng.integers(0, 10**9, n)]
    passage = fresh(70)
    changed = [*passage[:20], "new", *passage[21:45], "more", "words", *passage[45:60], *passage[62:]]
    rows = [(1, fresh(100) + passage + fresh(40)), (2, fresh(30) + passage + fresh(90)), (3, fresh(50) + changed + fresh(20)), (4, fresh(300)), (5, fresh(60) + passage[:30])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows] + [(i + 10 if i else i, t) for i, t in ODD], EMPTY)
    found = passages.passages(docs)
    got = {r.doc_id: (r.start_word, r.end_word, r.source_id) for r in found.collect()}
    assert got == {2: (30, 100, 1), 3: (50, 50 + len(changed), 1)}
    cut = {r.doc_id: r for r in passages.cut_passages(docs.withColumn("n_chars", F.length("text").cast("long")), found).collect()}
    assert len(cut[2].text.split()) == 120 and cut[4].text == " ".join(rows[3][1]) and cut[2].n_chars == len(cut[2].text)
    assert passages.passages(docs.limit(0)).count() == 0


def test_passages_of_low_identity(spark):
    """Passages of 50 to 100 words with 5 to 20 % of the words changed: found, with ends as far as matches reach."""
    rng = np.random.default_rng(7)
    fresh = lambda n: [f"q{x}" for x in rng.integers(0, 10**9, n)]
    rows, planted = [], {}
    for i, (n, share) in enumerate([(n, share) for n in (55, 70, 100) for share in (0.05, 0.1, 0.15, 0.18) for _ in range(15)] + [(n, None) for n in (59, 79, 99) for _ in range(15)]):
        passage, other = fresh(n), fresh(n)
        changed = np.arange(n) % 10 == 9 if share is None else np.isin(np.arange(n), 1 + rng.choice(n - 2, int(n * share), replace=False))
        same = [p for p in range(n) if not changed[p]]
        rows += [(i, fresh(40) + passage + fresh(40)), (1000 + i, fresh(30) + [o if c else p for p, o, c in zip(passage, other, changed, strict=True)] + fresh(50))]
        planted[1000 + i] = (share, 30 + same[0], 30 + same[-1] + 1, i)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], EMPTY)
    got = {(r.doc_id, r.source_id): (r.start_word, r.end_word) for r in passages.passages(docs).collect()}
    found = {i: (x := got.get((i, source))) is not None and x[0] <= a + 6 and x[1] >= b - 6 for i, (_, a, b, source) in planted.items()}
    for share in (0.05, 0.1, 0.15, 0.18, None):
        assert np.mean([found[i] for i, x in planted.items() if x[0] == share]) >= (0.9 if share == 0.18 else 0.97), share


def test_passages_with_a_sentence_in_the_middle(spark):
    """Words put in or replaced in the middle don't part a passage while enough of it matches."""
    rng = np.random.default_rng(8)
    fresh = lambda n: [f"q{x}" for x in rng.integers(0, 10**9, n)]
    rows, want = [], {}
    for i, (n, more, gone) in enumerate([(80, 7, 0), (80, 7, 7), (90, 8, 0), (98, 12, 0), (60, 8, 0), (64, 9, 9), (100, 20, 0), (60, 40, 0)]):
        passage, half = fresh(n), n // 2
        rows += [(i, fresh(40) + passage + fresh(40)), (100 + i, fresh(30) + passage[:half] + fresh(more) + passage[half + gone :] + fresh(50))]
        if n - gone >= 0.8 * (n + more - gone):
            want[100 + i] = (30, 30 + n + more - gone, i)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], EMPTY)
    assert {r.doc_id: (r.start_word, r.end_word, r.source_id) for r in passages.passages(docs).collect()} == want


def test_chain_is_the_best_of_all():
    rng = np.random.default_rng(4)
    for _ in range(30):
        segments = sorted({(int(p), int(s), int(n)) for p, s, n in zip(rng.integers(0, 60, 6), rng.integers(0, 60, 6), rng.integers(3, 9, 6), strict=True)})
        best = 0.0
        for mask in range(1, 1 << len(segments)):
            pick = [x for i, x in enumerate(segments) if mask >> i & 1]
            gaps = [(b[0] - a[0] - a[2], b[1] - a[1] - a[2]) for a, b in zip(pick, pick[1:])]
            if all(x >= 0 and y >= 0 for x, y in gaps):
                best = max(best, sum(x[2] for x in pick) - passages.GAP_COST * sum(x + y for x, y in gaps))
        pieces = passages.chain(segments)
        assert sorted(x for c in pieces for x in c) == segments
        scores = [sum(x[2] for x in c) - passages.GAP_COST * sum(b[0] - a[0] - a[2] + b[1] - a[1] - a[2] for a, b in zip(c, c[1:])) for c in pieces]
        assert max(scores) >= best - 1e-9 or any(b[0] - a[0] - a[2] > passages.MAX_GAP for c in [segments] for a, b in zip(c, c[1:]))


def test_neighbours(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = neighbours.nearest(table).collect()
    vectors = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in table.collect()}
    hits = 0
    queries = [i for i in vectors if i % 20 == 0]
    for q in queries:
        scores = {i: float((vectors[q] * v).sum()) for i, v in vectors.items() if i != q}
        want = sorted(scores, key=lambda i: (-scores[i], i))[:20]
        got = sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in got] == list(range(1, 21)) and all(abs(r.score - scores[r.vec_id]) < 1e-12 for r in got)
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        hits += len(set(want) & {r.vec_id for r in got})
    assert hits >= 0.9 * 20 * len(queries)


def test_neighbours_odd(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 60)] + [(100, [0.0, 0.0]), (101, None), (102, [1.0, None]), (103, [float("nan"), 1.0]), (104, [float("inf"), 1.0]), (105, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (106, [0.5, 5.0]), (0, [1.0, 0.0])]
    table = spark.createDataFrame([(i, v, "x", 2) for i, v in rows], "vec_id long, embedding array<float>, uid string, rank int")
    got = neighbours.nearest(table).collect()
    assert sorted({r.query_id for r in got}) == [0, 20, 40]
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 20), key=lambda r: r.rank)] == list(range(20))
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 0), key=lambda r: r.rank)] == list(range(1, 21))
    assert neighbours.nearest(table.limit(0)).count() == 0


def test_licences(spark):
    body = dict(licences.TEMPLATES)
    docs = spark.createDataFrame([(1, "Some words.\n" + body["MIT/notice"] + "\nmore words"), (2, body["MIT/text"].replace(" to deal ", " to really deal ")), (3, "released under no licence at all, just words"), *[(i + 10 if i else i, t) for i, t in ODD]], EMPTY)
    got = {(r.doc_id, r.unit): r.licence for r in licences.scan(docs).collect()}
    assert got == {(1, 1): "MIT/notice", (2, 0): "MIT/text"}
    assert licences.scan(docs.limit(0)).count() == 0


def test_pipeline(spark, texts):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {r.doc_id for r in rows} <= set(texts)
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    assert len(good & {r.doc_id for r in rows}) >= 0.7 * len(good)


def test_shuffle_files_of_passages_go_before_documents_are_cut(spark, docs):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {name for f in disk.getAllFiles().mkString("\n").split("\n") if (name := f.rsplit("/", 1)[-1]).startswith("shuffle_")}

    before, setting = shuffles(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    found = passages.passages(docs)
    end = time.time() + 20
    while time.time() < end and shuffles() - before:  # deletion goes on beside the session
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == setting
    assert found.count() == passages.passages(docs).count() > 0

"""Archives, vector codes and collocations against brute force, with odd rows."""

import gzip
import hashlib
import io
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from seriesloom.llm import archives, collocations, vector_codes
from seriesloom.llm.common import scratch

PAGES = "page_id long, url string, html string, payload_bytes int, first string"


def arc(version, records, zipped):
    head = f"{version} 0 own\n{archives.ARC_HEADINGS[version]}\n\n".encode()
    extra = " 200 - - 0 x.arc" if version == 2 else ""
    out = [f"filedesc://x.arc 0.0.0.0 20010203040506 text/plain{extra} {len(head)}\n".encode() + head]
    out += [f"{url} 1.2.3.4 20010203040506 {kind}{extra} {len(block)}\n".encode() + block + b"\n" for url, kind, block in records]
    return b"".join(map(gzip.compress, out)) if zipped else b"".join(out)


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("zipped", [True, False])
def test_arc_records_of_both_versions(version, zipped, monkeypatch):
    monkeypatch.setattr(archives, "READ", 7)  # every token crosses a read
    records = [("http://a/b c d", "text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nhello\n\nworld"), ("http://e/", "text/html", b""), ("dns:x", "text/dns", b"line\nhttp://no 1 2 3\n")]
    got = list(archives.arc_records(io.BytesIO(arc(version, records, zipped))))
    assert [(r.url, r.type, r.block) for r in got[1:]] == records and got[0].url.startswith("filedesc:")
    assert got[1].http() == (b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n", b"hello\n\nworld") and got[3].http()[0] == b""
    head, block = archives.warc_record("f/x.arc.gz", got[3], None)
    assert b"WARC-Type: resource" in head and b"WARC-Date: 2001-02-03T04:05:06Z" in head and block == records[2][2]
    assert archives.warc_record("g/x.arc.gz", got[3], None) == (head, block)  # identifiers stay the same


@pytest.mark.parametrize("data", [b"http://a 1.2.3.4 20010203040506 text/html 3\nabc\n", arc(1, [("http://a", "text/html", b"abcdef")], False)[:-4], arc(2, [("http://a", "x", b"abc")], False).replace(b"2 0 own", b"7 0 own"),
                                  arc(1, [("http://a", "text/html", b"abc")], False).replace(b"1.2.3.4 2001", b"1.2.3.4 xx01")])
def test_broken_archives_are_told(data):
    with pytest.raises(ValueError):
        list(archives.arc_records(io.BytesIO(data)))


def converted(spark, rows):
    arcs = archives.write_arc(spark.createDataFrame(rows, PAGES), scratch(spark, "arc"))
    return archives.read_warc(archives.convert_arc(arcs, scratch(spark, "warc"))).collect()


def test_pages_become_responses_and_revisits(spark):
    big, small, huge = "é" * 60, "x" * 99, "long " * 400_000
    rows = [(5, "http://a/x y", big, 1, "f"), (3, None, big, 1, "f"), (9, "http://b", big, 1, "f"), (None, "http://n", big, 1, "f"), (3, "http://again", big, 1, "f"),
            (1, "u", small, 1, "f"), (2, "u", small, 1, "f"), (7, "u", None, 1, "f"), (8, "u", "", 1, "f"), (11, "u", huge, 1, "f"), (12, "u", huge, 1, "f")]
    got = converted(spark, rows)
    assert len(got) == len(rows)
    want = {p: h or "" for p, _, h, _, _ in rows}
    for r in got:
        payload = want[r["page_id"]].encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == Counter([(3, "response", None), (3, "revisit", 3), (5, "revisit", 3), (9, "revisit", 3), (None, "revisit", 3), (1, "response", None), (2, "response", None),
                             (7, "response", None), (8, "response", None), (11, "response", None), (12, "revisit", 11)])
    ids = {r["record_id"]: r for r in got}
    assert len(ids) == len(rows) and all(ids[r["refers_to_id"]]["record_type"] == "response" for r in got if r["refers_to_id"])


def test_no_pages_no_records(spark):
    assert converted(spark, []) == []


def plain_codes(rows):
    kept = [(i, l, [x.as_integer_ratio()[0] * 4096 // x.as_integer_ratio()[1] for x in v])
            for i, l, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, label_error = [], defaultdict(int)
    for dims in {len(v) for _, _, v in kept}:
        mine = [r for r in kept if len(r[2]) == dims]
        bounds = [dims * p // 8 for p in range(9)]
        first = sorted(mine, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:16]
        codes, errors, books = [""] * len(mine), [0] * len(mine), []
        for a, b in zip(bounds, bounds[1:]):
            parts, book = [r[2][a:b] for r in mine], [r[2][a:b] for r in first]

            def distance(part, entry):
                return sum((x - y) ** 2 for x, y in zip(part, entry))

            def nearest(part):
                return min(range(len(book)), key=lambda e: (distance(part, book[e]), e))

            for _ in range(6):
                groups = defaultdict(list)
                for part in parts:
                    groups[nearest(part)].append(part)
                book = [[sum(c) // len(groups[e]) for c in zip(*groups[e])] if e in groups else entry for e, entry in enumerate(book)]
            for i, part in enumerate(parts):
                codes[i] += f"{nearest(part):02x}"
                errors[i] += distance(part, book[nearest(part)])
            books.append(book)
        digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
        for (i, l, _), c, e in zip(mine, codes, errors):
            out.append((i, l, c, e, digest))
            label_error[l] += e
    return Counter((i, c, e if e < 2**63 else None, None if label_error[l] >= 2**63 else label_error[l], d) for i, l, c, e, d in out)


def code_rows(spark, rows):
    df = spark.createDataFrame([(i, l, v, "x") for i, l, v in rows], "vec_id long, label int, embedding array<float>, error string")
    return Counter(tuple(r)[:5] for r in vector_codes.vector_codes(df).collect())


def as_floats(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


def test_codes_equal_plain_whole_number_rounds(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), int(i % 3) if i % 7 else None, as_floats(rng.normal(size=16))) for i in range(90)]
    rows += [(5, 1, rows[5][2]), (6, 1, as_floats(rng.normal(size=16))), (None, None, as_floats(rng.normal(size=16)))]  # repeated ids, a null id
    rows += [(200, 1, None), (201, 1, as_floats([float("nan")] + [0.0] * 15)), (202, 1, as_floats([float("inf")] + [0.0] * 15)), (203, 1, [None] + [0.0] * 15)]
    rows += [(300 + i, 9, as_floats(rng.normal(size=11))) for i in range(5)] + [(400, 9, [])]  # other lengths
    assert code_rows(spark, rows) == plain_codes(rows)


def test_codes_of_huge_components_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i, as_floats(rng.normal(size=8) * (1e30 if i % 5 == 0 else 1e5))) for i in range(40)]
    assert {k[:2] + k[4:] for k in code_rows(spark, rows)} == {k[:2] + k[4:] for k in plain_codes(rows)}


def test_no_vectors_no_codes(spark):
    assert code_rows(spark, []) == Counter()


def plain_collocations(rows, support, longest, top):
    import re

    pieces = defaultdict(list)
    for _, text, lang, _ in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        pieces[lang or "und"] += [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]
    out = set()
    for lang, found in pieces.items():
        n = sum(map(len, found))
        f = Counter(tuple(p[i : i + k]) for p in found for k in range(1, longest + 1) for i in range(len(p) - k + 1))
        often = {p: c for p, c in f.items() if c >= support}
        scored = []
        for p, a in often.items():
            inside = any(len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and c >= a for q, c in often.items())
            if len(p) > 1 and not inside:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, n, -s))
    return out


@pytest.mark.parametrize("ranges, passes", [(2_000_000, 1 << 14), (4500, 4)])
def test_phrases_equal_plain_counts(spark, monkeypatch, ranges, passes):
    monkeypatch.setattr(collocations, "RANGE_PHRASES", ranges)
    monkeypatch.setattr(collocations, "MOST_RANGES", passes)
    rng = np.random.default_rng(7)
    vocabulary = ["The", "of", "new", "York", "CITY", "é", "\x01", "a.b", "x\x00y", "ß"]
    rows = [(i, " ".join(rng.choice(vocabulary, p=[0.25, 0.2, 0.15, 0.1, 0.1, 0.05, 0.05, 0.04, 0.03, 0.03], size=int(rng.integers(0, 60)))), ["en", "de", None][i % 3], i) for i in range(120)]
    rows += [(500, None, "en", 1), (501, "", "en", 1), (502, "new\tYork  city\nnew york, a a a a a a a", "en", 1), (502, "new york", "en", 1), (503, "one two three " * 3000, "fr", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n long")
    got = {tuple(r) for r in collocations.collocations(df, support=8, longest=4, top=40, shards=3).collect()}
    assert got == plain_collocations(rows, 8, 4, 40)


def test_equal_keys_of_other_phrases_are_counted_apart():
    codes, words = np.array([1, 2, 1, 3, 1, 2], dtype=np.uint32), ["a", "b", "c"]
    phrases, n, keys = collocations._counted(codes, np.array([9, 9, 9], dtype=np.uint64), np.array([0, 2, 4]), 2, words)
    assert Counter(dict(zip(phrases, n.tolist()))) == {"a b": 2, "a c": 1} and keys.tolist() == [9, 9]


def test_no_documents_no_phrases(spark):
    assert collocations.collocations(spark.createDataFrame([], "doc_id long, text string, lang string")).collect() == []

"""Archives by round trip; licence scans against a search of word lists."""

import base64
import hashlib
import random
import re
import time

import zstandard

from newsloom.llm import licenses, warc
from newsloom.llm.queries import QUERIES

PAGES = "page_id long, url string, html string, payload string, second int, of long"


def pages(spark):
    rows = [(1, "http://a/1", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "http://b\r\nX: y", ""), (4, "u", None), (5, "u", "é" * 1000), (5, "u", "é" * 1000), (6, "u", "x" * 300_000), (None, "u", "<p>same</p>"), (7, "u", "a\r\n\r\nb")]
    return rows, spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], PAGES).repartition(2)


def test_round_trip(spark):
    rows, df = pages(spark)
    got = warc.read_bundles(warc.archive_pages(df)).collect()
    want, last = [], {}
    for i, _, html in rows:
        last[html or ""] = max(last.get(html or "", -1), -1 if i is None else i)
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = i is not None and i != last[html or ""]
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", last[html or ""] if revisit else None))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    bodies = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response"}
    assert bodies[7] == b"a\r\n\r\nb" and bodies[5] == ("é" * 1000).encode() and len(bodies[6]) == 300_000


def test_least_size(spark):
    _, df = pages(spark)
    got = warc.read_bundles(warc.archive_pages(df, least=100)).collect()
    assert {r.page_id for r in got if r.record_type == "revisit"} == set()


def test_frames_and_files(spark, tmp_path):
    """Any Zstandard reader decodes the whole file, and any frame alone."""
    _, df = pages(spark)
    data = [bytes(r.bundle) for r in warc.archive_pages(df).collect()]
    plain = b"".join(zstandard.ZstdDecompressor().stream_reader(b, read_across_frames=True).read() for b in data)
    assert plain.count(b"WARC/1.1\r\n") == 9
    for bundle in data:
        for start, packed, size in warc.read_seek_table(bundle).tolist():
            assert len(zstandard.ZstdDecompressor().decompress(bundle[start : start + packed], max_output_size=size)) == size
    files = warc.bundle_files(warc.archive_pages(df), f"file://{tmp_path}").collect()
    assert {f.name for f in files} == {p.name for p in tmp_path.iterdir()}


def test_no_pages(spark):
    assert warc.read_bundles(warc.archive_pages(spark.createDataFrame([], PAGES))).collect() == []


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words, hits = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), []
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        hits += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return len(words), len(hits), min(hits)[0] if hits else None, max(hits)[0] if hits else None, ",".join(sorted({x for _, x in hits}))


def test_scan_odd_rows(spark, odd, odd_rows, empty):
    got = sorted((tuple(r)[:6] for r in licenses.scan_licenses(odd).collect()), key=str)
    assert got == sorted(((r[0], *brute(r[1])) for r in odd_rows), key=str)
    assert licenses.scan_licenses(empty).collect() == []


def test_phrases(spark):
    texts = [
        "Under the MIT--License, under\nthe mit license", "CC BY-NC 4.0 and cc.by.nc", "under the mit licensed", "Apache License, Version 2.0",
        "apache license version 2", "xunder the mit license", "ünder the mit license", "cc by ncé", "cc by nc by nc cc by nc",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan_licenses(df).collect():
        assert tuple(r)[1:6] == brute(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_whole_table(spark, real):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{real}/documents.parquet").collect()}
    for r in QUERIES["op7_license_scan"](spark, real).collect():
        assert tuple(r)[1:6] == brute(texts[r.doc_id])


def test_expressions():
    def value(text):
        found, used = licenses.evaluate(text.lower().replace("(", " ( ").replace(")", " ) ").split())
        return found and (found.freedom, sorted(found.labels)), used

    assert value("MIT OR GPL-2.0 AND GPL-3.0") == ((1.0, ["gpl-2", "gpl-3", "mit"]), 5)
    assert value("( MIT OR GPL-2.0 ) AND GPL-3.0") == ((0.4, ["gpl-2", "gpl-3", "mit"]), 7)
    assert value("GPL-2.0 WITH Classpath-exception-2.0 AND MIT") == ((0.4, ["gpl-2", "mit"]), 5)
    assert value("MIT and") == ((1.0, ["mit"]), 1)
    assert value("( MIT or ISC") == (None, 0)
    assert value("and MIT") == (None, 0)
    assert value("MIT ) or ISC") == ((1.0, ["mit"]), 1)


def test_long_expressions(spark):
    """Labels and the strictest licence behind the 64th token count, in lists and in brackets."""
    some = " AND ".join(["MIT", "ISC"] * 40)
    texts = [
        f"SPDX-License-Identifier: {some} AND GPL-3.0-only", f"SPDX-License-Identifier: ({some} AND GPL-3.0-only) OR LGPL-2.1 tail",
        "License-Expression: " + "(" * 5000 + "MIT" + ")" * 5000, "License-Expression: " + " or ".join(f"own-{i}" for i in range(20_000)) + "\nand MIT",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(df).collect()}
    assert got[0] == ("gpl-3,isc,mit", 0.4) and got[1] == ("gpl-3,isc,lgpl,mit", 0.5) and got[2] == ("mit", 1.0)
    assert got[3] == (",".join(sorted(f"own-{i}" for i in range(20_000))), 0.5)


def test_valid_beginnings():
    """Against a recursive parser over all short lists of tokens."""
    import itertools

    def parse(tokens):
        def operand(i):
            if i < len(tokens) and tokens[i] == "(":
                i = expression(i + 1)
                return i + 1 if i is not None and i < len(tokens) and tokens[i] == ")" else None
            return i + 1 if i < len(tokens) and tokens[i] == "mit" else None

        def expression(i):
            i = operand(i)
            while i is not None and i < len(tokens) and tokens[i] == "or":
                i = operand(i + 1)
            return i

        return expression(0) == len(tokens)

    for n in range(7):
        for tokens in itertools.product(["mit", "or", "(", ")"], repeat=n):
            want = max((k for k in range(n + 1) if parse(tokens[:k])), default=0)
            assert licenses.evaluate(list(tokens))[1] == want, tokens


def test_expressions_equal_reading_on_from_each_tag():
    """Against ``evaluate``, which reads the rest of the line from each tag that is in no expression yet."""
    rng = random.Random(4)
    scanner = licenses.Scanner(licenses.BASE_PHRASES, licenses.NOTICE_PHRASES)
    pieces = ["mit", "and", "or", "with", "(", ")", "gpl-3.0", "license-expression", "license-expression-", "license expression: ", "license-expressionor", "x", "\n", "(", "and", "or"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) + rng.choice([" ", " ", ""]) for _ in range(rng.randint(1, 25)))
        want, done = [], -1
        for hit in scanner.tag.finditer(text):
            end = text.find("\n", hit.end())
            end = len(text) if end < 0 else end
            if hit.start() < done:
                continue
            tokens = list(licenses._TOKEN.finditer(text, hit.end(), end))
            value, n = licenses.evaluate(t[0] for t in tokens)
            if value is not None:
                want.append(value)
                done = tokens[n - 1].end()
        assert scanner.expressions(text) == want, text


def test_a_long_line_is_read_once():
    scanner = licenses.Scanner(licenses.BASE_PHRASES, licenses.NOTICE_PHRASES)
    for text in ("license-expression-mit and " * 40_000, "license-expression-mit and ( " * 40_000, "license-expression(mit and " * 40_000):
        began = time.process_time()
        scanner.scan(text.encode())
        assert time.process_time() - began < 10


def test_records_share_frames_and_are_found_by_their_ids(spark, monkeypatch):
    """A lookup decodes the frame of its record and no other: all other frames may be damaged."""
    html = ["".join(random.Random(i).choices("abc <p>", k=3000)) for i in range(400)]
    rows = [(i, f"http://h/{i}", h) for i, h in enumerate(html)] + [(900, "u", html[7]), (None, "u", "x" * 400_000)]
    bundles = warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1))
    first = bundles.orderBy("number").first()
    assert max(first.offsets) > 0 and 1 < len(set(first.frames)) < 20
    index = warc.record_index(bundles)
    assert index.count() == 402
    ids = spark.createDataFrame([(5,), (399,), (7,), (5,), (12345,), (None,)], "page_id long")
    got = {r.page_id: r for r in warc.find_records(bundles, index, ids).collect()}
    assert set(got) == {5, 7, 399} and got[5].payload.decode() == html[5] and (got[7].record_type, got[7].refers_to) == ("revisit", 900)

    place = index.where("page_id = 150").first()
    archive = next(r for r in bundles.collect() if r.number == place.number)
    table = warc.read_seek_table(bytes(archive.bundle))
    start, packed, _ = table[place.frame].tolist()
    end = int(table[-1][0] + table[-1][1])
    damaged = bytes(start) + bytes(archive.bundle)[start : start + packed] + bytes(end - start - packed) + bytes(archive.bundle)[end:]
    plain = warc.read_frame(damaged, table, place.frame)
    assert warc.parse_record(plain[place.offset : place.offset + place.length])[1].decode() == html[150]

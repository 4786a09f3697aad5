"""Exact dedup, archive, SimHash, decontamination and BPE against brute force,
on rows with nulls, empty and long texts, ties, repeats and extra columns."""

import base64
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from asofra.llm import byte_bpe, decontaminate, exact_dedup, pii, simhash, warc
from asofra.llm import components as connected
from asofra.llm.components import components

#: Extra columns with names that the operators use themselves.
EXTRA = ["lang", "digest", "_len", "row", "spans", "text_id", "_kept_id", "_gone_id", "_gone_text", "_sha", "_row", "_spans", "component_id", "node", "_SALT"]
DOCS = "doc_id long, text string, " + ", ".join(f"{c} string" for c in EXTRA)


def corpus():
    rng = random.Random(5)
    words = ["the", "cat", "Über", "naïve", "x1", "sat", "on", "mat", "日本", "end.", "go-to", "a"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)]
    texts += [None, "", " ", "\n\t", "A", "a", "é", "É", texts[0], texts[0].upper(), texts[1] + "!", "x" * 5000]
    texts += [" ".join(rng.choices(words, k=4000)), texts[3], texts[3]]
    rows = [(k, t, *(f"{c}{k}" for c in EXTRA)) for k, t in enumerate(texts)]
    return rows + [rows[3], (None, "no id", *[None] * len(EXTRA)), (None, "cat", *[None] * len(EXTRA))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def key(rows):
    return sorted(rows, key=repr)


def test_exact_dedup(docs, none):
    groups = {}
    for doc_id, text, *_ in corpus():
        groups.setdefault(lower(text), []).append(doc_id)
    want = []
    for doc_id, text, *_ in corpus():
        ids = groups[lower(text)]
        keep = max((i for i in ids if i is not None), default=None)
        want.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(lower(text).encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.refine(docs, digest_unique=True).collect()]
    assert key(got) == key(want)
    assert exact_dedup.refine(none).count() == 0


def test_exact_dedup_reads_full_content_of_survivors_only(docs):
    rows = exact_dedup.refine(docs).collect()
    assert any(r.text_sha256 is None for r in rows)
    assert all(r.text_sha256 for r in rows if r.group_size > 1)


def test_exact_dedup_keeps_columns(docs):
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    texts = [lower(r.text) for r in kept.where("doc_id IS NOT NULL AND doc_id <> 3").collect()]
    assert len(texts) == len(set(texts))


def test_warc(spark, tmp_path):
    pages = [(1, "http://a", "<p>x</p>", "z"), (2, "http://b\nc", "<p>x</p>", "z"), (3, None, None, "z"), (4, "u", "", "z"),
             (5, "u", "é" * 1000, "z"), (5, "u", "é" * 1000, "z"), (None, "u", "<p>x</p>", "z"), (6, "u", "only", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, digest string")
    path = warc.write_archive(df, str(tmp_path / "a"))
    got = warc.read_archive(spark, path).collect()
    first = {}
    for i, _, h, _ in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h, _ in pages:
        raw, keep = (h or "").encode(), first[h or ""]
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((i, len(raw), sha, "response" if i == keep else "revisit", None if i == keep else keep))
    assert key((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == key(want)
    records = {r.page_id: bytes(r.record).decode() for r in warc.reconstruct(spark, path).collect()}
    assert records[5].endswith("Content-Length: 2000\r\n\r\n" + "é" * 1000) and "WARC-Type: response\r\n" in records[5]
    assert "WARC-Refers-To: <urn:page:1:" in records[2] and records[2].endswith("Content-Length: 0\r\n\r\n")
    assert "HTTP/1.1 200 OK\r\n" in records[1] and records[1].endswith("\r\n\r\n<p>x</p>")
    assert warc.read_payloads(spark, path).count() == len(first)
    warc.export_files(spark, path, str(tmp_path / "files"))
    back = warc.read_files(spark, str(tmp_path / "files/part-*"))
    assert key((r.page_id, bytes(r.record)) for r in back.collect()) == key((r.page_id, bytes(r.record)) for r in warc.reconstruct(spark, path).collect())
    again = key((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in warc.parsed(back).collect())
    assert again == key((i, sha, kind, keep) for i, _, sha, kind, keep in want)
    small = warc.write_archive(df, str(tmp_path / "c"), smallest=9)
    got = {r.page_id: (r.record_type, r.payload_bytes) for r in warc.read_archive(spark, small).collect()}
    assert got[2] == ("response", 8) and got[4] == ("response", 0) and got[5] == ("response", 2000)
    empty = warc.write_archive(df.limit(0), str(tmp_path / "b"))
    assert warc.read_archive(spark, empty).count() == 0


def test_warc_detects_altered_payload(spark, tmp_path):
    path = warc.write_archive(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), str(tmp_path / "a"))
    row = warc.read_payloads(spark, path).first()
    changed = spark.createDataFrame([(row.digest, row.holder, bytearray(b"abd"))], "digest string, holder string, payload binary")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    changed.write.mode("overwrite").option("path", f"{path}/payloads").bucketBy(buckets, "digest", "holder").saveAsTable("altered")
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_archive(spark, path).collect()


def brute_fingerprint(text, words=4):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def brute_components(found, near):
    label = list(range(len(found)))
    changed = True
    while changed:
        changed = False
        for i in range(len(found)):
            for j in range(len(found)):
                if near(found[i], found[j]) and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_simhash(docs, none):
    rows = corpus()
    found = [brute_fingerprint(r[1]) for r in rows]
    label = brute_components(found, lambda a, b: (a ^ b).bit_count() <= 4)
    want = []
    for k, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[k] and rows[j][0] is not None]
        want.append((row[0], found[k], min(ids, default=None)))
    got = [(r.doc_id, r.a % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert key(got) == key(want)
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("radius", [0, 2, 4, 8, 11])
def test_simhash_links_lose_nothing(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(25)]
    found = list(dict.fromkeys(b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, radius + 3))) for b in base for _ in range(14)))
    signed = [x - (1 << 64) if x >> 63 else x for x in found]
    nodes = spark.createDataFrame([(s, s, 0) for s in signed], "node long, a long, b long")
    roots = {r.node: r.root for r in components(simhash.links(nodes, radius)).collect()}
    label = brute_components(found, lambda a, b: (a ^ b).bit_count() <= radius)
    groups = {}
    for k, s in enumerate(signed):
        groups.setdefault(label[k], set()).add(s)
    got = {}
    for s in signed:
        got.setdefault(roots.get(s, s), set()).add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_simhash_keeps_one_of_each_group(spark):
    rng = random.Random(1)
    long = ["w%d" % rng.randint(0, 10**6) for _ in range(400)]
    near = [*long[:200], "changed", *long[201:]]
    other = ["v%d" % rng.randint(0, 10**6) for _ in range(400)]
    rows = [(7, " ".join(long), "x"), (3, " ".join(near), "y"), (9, " ".join(other), "z"), (9, " ".join(other), "z")]
    kept = simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string, a string"))
    assert kept.columns == ["doc_id", "text", "a"]
    assert sorted(r.doc_id for r in kept.collect()) == [3, 9, 9]


def word_sets(text):
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


@pytest.mark.parametrize("block", [1024, 6])
def test_near_copies_are_those_of_similarity_0_8(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "PIVOTS", 2)
    rng = random.Random(9)
    texts = []
    for _ in range(12):
        base = ["w%d" % rng.randint(0, 10**6) for _ in range(200)]
        for _ in range(8):
            # one word changes five shingles of 196; four changes leave 0.815, five 0.77
            copy = base[:]
            for at in rng.sample(range(2, 38), rng.randint(0, 5)):
                copy[at * 5] = "c%d" % rng.randint(0, 10**6)
            texts.append(" ".join(copy))
    texts += ["few words", "few Words", "", " "]
    sets = [word_sets(t) for t in texts]
    label = brute_components(sets, lambda a, b: 5 * len(a & b) >= 4 * len(a | b))
    want = {min(j for j in range(len(texts)) if label[j] == label[k]) for k in range(len(texts))}
    kept = simhash.deduplicate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    assert {r.doc_id for r in kept.collect()} == want



def test_deduplicated_rows_keep_every_column(spark, docs):
    """Columns named like the operators' own come back as they were."""
    rows = {tuple(r) for r in docs.collect()}
    for operator in (exact_dedup.deduplicate, simhash.deduplicate):
        kept = operator(docs)
        assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} <= rows
    at = docs.columns.index("text")
    clean = [tuple(r) for r in pii.sanitise(docs).collect()]
    assert key(r[:at] + r[at + 1 :] for r in clean) == key(tuple(r)[:at] + tuple(r)[at + 1 :] for r in docs.collect())


@pytest.mark.parametrize("radius,low", [(2, 4), (4, 6), (8, 30), (14, 5)])
def test_first_shared_key(spark, radius, low):
    rng = np.random.default_rng(radius)
    x = rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)
    x[:40] &= np.uint64(0xFFFF)
    y = x.copy()
    for k in range(radius + 2):
        y[k % 3 :: 3] ^= np.uint64(1) << rng.integers(0, 64, y[k % 3 :: 3].size, dtype=np.uint64)
    both = np.concatenate((x, y))
    rows = [(int(v),) for v in both.view(np.int64)]
    keys, parts = [set() for _ in rows], {}
    for k, r in enumerate(spark.createDataFrame(rows, "a long").select(simhash._parts(F.col("a"), radius, low)).collect()):
        assert len(set(r[0])) == len(r[0])
        for part in r[0]:
            parts.setdefault(part, []).append(k)
    for part, own in parts.items():
        at, found = simhash.table_keys(both[own], part, radius, low)
        assert (np.diff(found) >= 0).all()
        for k, key_ in zip(at.tolist(), found.tolist()):
            assert key_ not in keys[own[k]]
            keys[own[k]].add(key_)
    want = [min(p & q, default=-1) for p, q in zip(keys[: x.size], keys[x.size :])]
    assert simhash.first_shared(x, y, radius).tolist() == want
    assert all(p & q for p, q, u, v in zip(keys, keys[x.size :], x, y) if (int(u) ^ int(v)).bit_count() <= radius)


@pytest.mark.parametrize("contracted", [1, 20, 1 << 20])
def test_components_of_any_size(spark, monkeypatch, contracted):
    monkeypatch.setattr(connected, "CONTRACTED", contracted)
    rng = random.Random(contracted)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(190)] + [(k, k + 1) for k in range(500, 560)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()}
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in root:
        for u, v in edges:
            if u != v:
                root[u] = root[v] = min(root[u], root[v])
    assert got == root


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (None, 1), (2, 1)] + [(100, k) for k in range(101, 180)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {k: got[k] for k in (1, 2, 3, 4)} == dict.fromkeys((1, 2, 3, 4), 1)
    assert {k: got[k] for k in (7, 8, 9)} == dict.fromkeys((7, 8, 9), 7)
    assert got[179] == 100 and 5 not in got
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(docs, items, window):
    windows = {}
    for item, text in items:
        words = WORD.findall(lower(text))
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if size and item is not None else 0):
            windows.setdefault(tuple(words[k : k + size]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        words, hit, found = WORD.findall(lower(text)), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if own := windows.get(tuple(words[k : k + size])):
                    found |= own
                    hit.update(range(k, k + size))
        out.append((doc_id, len(words), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("window,shard", [(10, 1 << 21), (3, 40), (1, 100)])
def test_decontamination(spark, docs, none, monkeypatch, window, shard):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 30)
    texts = [r[1] for r in corpus() if r[1]]
    items = [(1, texts[0]), (2, texts[5] + " unseen"), (3, "THE cat"), (4, None), (5, "..."), (None, texts[2]), (6, texts[7]), (6, texts[8]), (70, texts[0]), (8, "naïve日本")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.contamination(docs, bench, window).collect()]
    want = brute_hits([r[:2] for r in corpus()], items, window)
    assert key(got) == key(want)
    clean = decontaminate.keep_clean(docs, bench, window)
    assert clean.columns == docs.columns
    assert key(r.doc_id for r in clean.collect()) == key(d for d, _, n, _ in want if n == 0)
    assert decontaminate.contamination(docs, bench.limit(0), window).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(none, bench, window).count() == 0


def test_decontamination_spans(spark):
    docs = spark.createDataFrame([(1, "Keep this, the quick brown fox jumps. And that.")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "THE QUICK brown fox jumps")], "item_id long, text string")
    row = decontaminate.contamination(docs, bench, 3).first()
    spans = [(s.first, s.end) for s in row.spans]
    assert spans == [(2, 7)]
    assert decontaminate.without_spans(docs.first().text, spans) == "Keep this, . And that."


RANKS = {bytes([b]): b for b in range(256)} | {b"th": 256, b"the": 257, b" the": 258, "é".encode(): 259, b"ca": 260, b"  ": 261}
PATTERN = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@pytest.mark.parametrize("block", [64, 4 << 20])
def test_byte_bpe(spark, docs, none, monkeypatch, block):
    import tiktoken

    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", block)
    monkeypatch.setattr(byte_bpe, "CHUNK", 50)
    whole = tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
    encoded = byte_bpe.encode(docs, RANKS, PATTERN).cache()
    want = [(r[0], whole.encode_ordinary(r[1] or "")) for r in corpus()]
    assert key((r.doc_id, list(r.ids)) for r in encoded.collect()) == key(want)
    back = byte_bpe.decode(encoded, RANKS).collect()
    assert key((r.doc_id, bytes(r.decoded).decode()) for r in back) == key((r[0], r[1] or "") for r in corpus())
    fused = byte_bpe.encode(docs, RANKS, PATTERN, decoded=True).collect()
    assert key((r.doc_id, bytes(r.decoded)) for r in fused) == key((r.doc_id, bytes(r.decoded)) for r in back)
    assert byte_bpe.encode(none, RANKS, PATTERN).count() == 0
    for kind, value in (("smallint", "7"), ("date", "'2024-01-02'"), ("decimal(9,2)", "1.5")):
        other = docs.selectExpr(f"CAST({value} AS {kind}) AS doc_id", "text")
        assert key(tuple(r.ids) for r in byte_bpe.encode(other, RANKS, PATTERN).collect()) == key(tuple(i) for _, i in want)
    monkeypatch.setattr(byte_bpe, "MOST_KNOWN", 3)
    assert key((r.doc_id, list(r.ids)) for r in byte_bpe.encode(docs, RANKS, PATTERN).collect()) == key(want)


def test_byte_bpe_rejects_unknown_ids(spark):
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([([999999],)], "ids array<int>"), RANKS).collect()
    assert byte_bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), RANKS).first().decoded == b""

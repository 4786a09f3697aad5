"""Language, quality, toxicity, extraction and personal data."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest
import regex
import xxhash
import zstandard

from asofra.llm import fm_index, html_extract, html_labelled, html_tree, language_id, pii, quality, toxicity
from asofra.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("seed", range(6))
def test_fm_index(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(1, 3 + seed * 3, 400)
    index = fm_index.FMIndex(text, int(text.max()))
    assert (fm_index.suffix_array(np.append(text, 0)) == sorted(range(401), key=lambda k: tuple(np.append(text, 0)[k:]))).all()
    for width in (1, 2, 5):
        patterns = np.stack([text[k : k + width] for k in rng.integers(0, 400 - width, 12)] + [rng.integers(1, 3, width) for _ in range(3)])
        for pattern, low, high in zip(patterns, *index.search(patterns)):
            want = [k for k in range(401 - width) if (text[k : k + width] == pattern).all()]
            assert sorted(index.locate(np.arange(low, high)).tolist()) == want


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(2)
    sounds = {"aa": "ka lo mi ta re", "bb": "sch ung eit berg pf"}
    rows = [(k, "".join(rng.choices(sounds[lang].split(), k=3)) + " " + " ".join("".join(rng.choices(sounds[lang].split(), k=2)) for _ in range(20)), lang) for k in range(120) for lang in (("aa", "bb")[k % 2],)]
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "12 !", None), (None, "lomika", "aa"), (7, rows[7][1], "bb")]
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")


def test_language_id(spark, tongues):
    model = language_id.fit(tongues)
    assert model.classes == ["aa", "bb"]
    got = {r.doc_id: r for r in language_id.predict(tongues, model).collect()}
    truth = {r.doc_id: r.lang for r in tongues.collect()}
    assert all(got[k].lang_pred == truth[k] and 0 <= got[k].score <= 1 for k in range(120))
    assert [got[k].lang_pred for k in (200, 201, 202)] == ["und"] * 3 and got[200].score == 0
    assert language_id.predict(tongues.limit(0), model).count() == 0
    nothing = language_id.fit(tongues.limit(0))
    assert language_id.predict(tongues, nothing).where("lang_pred <> 'und'").count() == 0


def test_language_score_does_not_depend_on_the_batch(tongues):
    model = language_id.fit(tongues)
    texts = [r.text or "" for r in tongues.collect()] + ["kalo " * 70000]
    langs, scores = language_id.score(texts, model)
    for k, text in enumerate(texts):
        lang, score = language_id.score([text], model)
        assert lang == [langs[k]] and np.allclose(score, scores[k])


def labelled(spark, bad, column):
    rng = random.Random(3)
    rows, marks = [], []
    for k in range(160):
        words = ["".join(rng.choices("ka lo mi ta re su".split(), k=rng.randint(1, 3))) for _ in range(40)]
        wrong = k % 4 == 0
        rows.append((k, bad(words, rng) if wrong else " ".join(words), 0.5))
        marks.append((k, int(wrong) if column == "toxic" else int(not wrong)))
    rows += [(900, None, 0.1), (901, "", 0.1), (902, "x" * 30000 + " lo " * 90000, 0.1), (None, "lo mi", 0.1), (3, rows[3][1], 0.5)]
    marks += [(5, 0), (5, 1), (None, 1), (6, None), (900, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, score double"), spark.createDataFrame(marks, f"doc_id long, {column} int")


def test_quality(spark):
    docs, labels = labelled(spark, lambda w, rng: " ".join(x.upper() + "!!" for x in w), "quality")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r.s for r in docs.select("doc_id", quality.scored(docs, model).alias("s")).collect()}
    assert all((got[k] >= quality.THRESHOLD) == (k % 4 != 0) for k in range(160))
    assert all(0 <= s <= 1 for s in got.values()) and got[900] == got[901]
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id < 160 AND doc_id % 4 = 0").count() == 0
    blank = quality.fit(docs, labels.limit(0))
    assert docs.select(quality.scored(docs, blank).alias("s")).where("s <> 0.5").count() == 0
    assert quality.keep_good(docs.limit(0), model).count() == 0


def test_quality_score_does_not_depend_on_the_neighbour():
    model = quality.Model(np.random.default_rng(0).normal(size=quality.BUCKETS), 0.3)
    for text in ("", "lomika", "a"):
        alone = quality.scores([text], model)[0]
        assert all(quality.scores([text, n, text], model)[[0, 2]].tolist() == [alone] * 2 for n in ("", "kalo mi", "X!! Y"))
    assert quality.scores(["", "kalo"], model)[0] == 1 / (1 + np.exp(-0.3))


AWKWARD = ["", " ", "a", "\t\n", "the quick  brown\tfox fox fox jumps   over é𝟘 the lazy\ndog " * 6 + "x" * 90 + "  end", "日本 語" * 30]


def slow_quality_features(text):
    """Words and pairs, and n-grams within a word and its spaces, one by one."""
    mask = (1 << 64) - 1
    mix = int(quality.MIX)

    def bucket(value, kind):
        mixed = (value + kind) * mix & mask
        mixed ^= mixed >> 29
        return (mixed * mix & mask) >> (64 - quality.BUCKETS_LOG2)

    def word_hash(word):
        total = 0
        for k, c in enumerate(word):
            term = (ord(c) + 1) * ((2 * k + 1) * mix & mask) & mask
            total += (term ^ term >> 31) * mix
        return total & mask

    words = [w for w in re.split("[\t-\r ]", text) if w]
    hashes = [word_hash(w) for w in words]
    own = [bucket(h, 1) for h in hashes] + [bucket(0 if x == y else (x * 3 + y) & mask, 2) for x, y in zip(hashes, hashes[1:])]
    grams = []
    # words one space apart share that space, and each gap has both its ends
    for n in quality.GRAMS:
        for word in words:
            spaced = f" {word} "
            for k in range(len(spaced) - n + 1):
                value = 0
                for c in spaced[k : k + n]:
                    value = (value * int(quality.CHARACTER) + ord(c)) & mask
                grams.append(bucket(value, 2 + n))
    return sorted(own), sorted(grams)


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 18])
def test_quality_features_against_a_slow_version(monkeypatch, chunk):
    monkeypatch.setattr(quality, "CHUNK", chunk)
    for text in AWKWARD:
        found = [[], []]
        for _, group, skip in quality._groups([text]):
            for kind, (_, bucket) in enumerate(quality.features(group, skip)):
                found[kind] += bucket.tolist()
        assert tuple(map(sorted, found)) == slow_quality_features(text)


def test_quality_scores_against_a_slow_version(spark):
    """The whole query on sf0.001, scored feature by feature."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"))
    got = {r.doc_id: r for r in QUERIES["op4_quality_classifier"](spark, SF).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        logit = model.bias + sum(np.mean(model.weights[f]) if f else 0.0 for f in slow_quality_features(text or ""))
        assert got[doc_id].score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-6)
        assert got[doc_id].predicted == int(got[doc_id].score >= 0.7)


def test_toxicity(spark):
    def insult(words, rng):
        words[rng.randint(0, 39)] = rng.choice(["dreadfulinsult", "nastyremark"])
        return " ".join(words)

    docs, labels = labelled(spark, insult, "toxic")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.predict(docs, model).collect()}
    assert np.mean([(got[k] >= toxicity.THRESHOLD) == (k % 4 == 0) for k in range(160)]) > 0.95
    assert got[900] == got[901] and all(0 <= s <= 1 for s in got.values())
    assert toxicity.predict(docs.limit(0), model).count() == 0
    one = toxicity.fit(docs, labels.where("toxic = 0"))
    assert toxicity.predict(docs, one).where("score >= 0.3").count() == 0


def slow_windows(text):
    """WINDOW words a window, with the white space behind them and a space in front."""
    spaced = b" " + re.sub(rb"[\t-\r]", b" ", text.lower()) + b" "
    words = [m.start() for m in re.finditer(rb"[^ ]+", spaced)][:: toxicity.WINDOW]
    return [spaced[a - 1 : b] for a, b in zip(words, [*words[1:], len(spaced)])]


def test_toxicity_windows_against_a_slow_version():
    for text in [*(t.encode() for t in AWKWARD), b"a " * 100_000, b"x" * 300_000]:
        assert list(toxicity.windows(text)) == slow_windows(text)


def test_toxicity_scores_against_a_slow_version(spark):
    """The whole query on sf0.001, each window compressed on its own."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"))
    got = {r.doc_id: r for r in QUERIES["op3_toxicity"](spark, SF).collect()}

    def length(window, content):
        kind = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        form = zstandard.ZstdCompressionParameters.from_level(
            toxicity.LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        kind.precompute_compress(compression_params=form)
        return len(zstandard.ZstdCompressor(dict_data=kind, compression_params=form).compress(window))

    for doc_id, text in docs.select("doc_id", "text").orderBy("doc_id").limit(40).collect():
        gain = sorted(length(w, model.ordinary) - length(w, model.toxic) for w in slow_windows((text or "").encode()))
        found = [gain[-1], np.mean(gain[-3:]), np.mean(gain), *(np.mean([g >= h for g in gain]) for h in toxicity.HITS), np.log(len(gain))] if gain else [0.0] * toxicity.EVIDENCE
        logit = ((np.array(found) - model.center) / model.scale) @ model.weights + model.bias
        assert got[doc_id].score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-9)
        assert got[doc_id].predicted == int(got[doc_id].score >= 0.3)


def test_toxicity_dictionary_is_trained_on_toxic_stretches():
    rng = random.Random(5)
    plain = [" ".join("".join(rng.choices("ka lo mi ta re su".split(), k=3)) for _ in range(60)) for _ in range(60)]
    toxic = [p.replace(p.split()[9], "dreadfulinsult") for p in plain[:30]]
    texts, label = [t.encode() for t in toxic + plain[30:]], np.arange(60) < 30
    sets = [toxicity._sorted_set(toxicity._grams(toxicity._spaced(t))) for t in texts]
    found = toxicity.stretches(texts, sets, label)
    assert found and all(b"dreadfulinsult" in s for s in found)
    ordinary, both = toxicity.train_dictionaries(texts, sets, label)
    assert both.startswith(ordinary) and b"dreadfulinsult" in both and b"dreadfulinsult" not in ordinary


def slow_language(text, model):
    """Naive Bayes one n-gram at a time."""
    mask, letters = (1 << 64) - 1, 0
    folded = []
    for c in text:
        letters += c.isalpha()
        folded.append(ord(c.lower()[0]) if c.isalpha() else 32)
    total = model.prior.copy()
    folded += [32] * (2 * language_id.LONGEST)
    for k in range(len(text) + language_id.LONGEST):
        value = 0
        for n in range(language_id.LONGEST):
            value = (value + folded[k + n] + n + 1) * int(language_id.MIX) & mask
            total = total + model.log_probs[value >> (64 - language_id.BINS_LOG2)]
    chance = np.exp(total - total.max())
    return ("und", 0.0) if not letters else (model.classes[int(total.argmax())], 1 / chance.sum())


def test_language_against_a_slow_version(spark):
    """The whole query on sf0.001, and texts with no letter."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0"))
    got = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, SF).collect()}
    for doc_id, text in docs.select("doc_id", "text").where("length(text) < 4000").orderBy("doc_id").limit(60).collect():
        lang, score = slow_language(text or "", model)
        assert got[doc_id].lang_pred == lang and got[doc_id].score == pytest.approx(score, abs=1e-6)
    langs, scores = language_id.score(["😀😀", "𝟘𝟙", "12 !", "𐐀a"], model)
    assert langs[:3] == ["und"] * 3 and langs[3] != "und" and scores[:3].tolist() == [0.0] * 3


def gold_text(page):
    tree = html_tree.parse(page)
    labels = html_extract._labels([tree])
    return html_tree.joined(tree, [k for k, t in enumerate(tree.tag) if t == "#text" and labels[k] == 1])


def test_extraction_of_unseen_pages():
    pages = [html_labelled.page(s) for s in range(50_000, 50_080)]
    bare = [re.sub(r' data-gold="\d"', "", p) for p in pages]
    found = html_extract.extract(bare, html_extract.default_model())
    words = [(gold_text(p).split(), f.split()) for p, f in zip(pages, found)]
    assert np.mean([a == b for a, b in words]) > 0.85
    assert found == [html_extract.extract([p], html_extract.default_model())[0] for p in bare]


def test_messages_are_exact():
    """Marginals by messages against all labellings of a small tree."""
    rng = np.random.default_rng(0)
    tree = html_tree.parse("<div class=post><p>Some text.<b>x</b><p>y</div>")
    trees = html_extract.forest([tree])
    model = html_extract.Model({n: html_extract.NUMBERS + k for k, n in enumerate(sorted(set(trees.name)))}, None, rng.normal(size=(4, 2, 2)))
    model.weights = rng.normal(size=html_extract.NUMBERS + len(model.columns))
    own, size = html_extract._evidence(trees, model), trees.parent.size
    weight, total = np.zeros(size), 0.0
    for mask in range(1 << size):
        y = mask >> np.arange(size) & 1
        value = np.exp(own @ y + sum(model.pairs[trees.kind[k], y[trees.parent[k]], y[k]] for k in range(size) if trees.parent[k] >= 0))
        weight += value * y
        total += value
    assert np.allclose(html_extract.marginals(trees, model), weight / total)


def test_parser_accepts_anything():
    tree = html_tree.parse("<p>a<b>b<br>c<p>d&amp;e &#233; <!-- x --><script>if (a<b) '</p>'</script><a href='x>y'>l</a></i></p> <li>1<li>2 < 3 <td")
    assert html_tree.joined(tree, [k for k, t in enumerate(tree.tag) if t == "#text"]) == "ab c d&e é l 1 2 < 3"
    for page in ("", "<", "<!--", "<p", "</", "<a b='", "<script>", "&#x", "<" * 50, "<div>" * 3000, "<b>" * 50_000 + "</i>" * 50_000, "<li>" * 50_000):
        html_tree.parse(page)
    assert html_extract.extract(["", "<div>" * 300, "plain"], html_extract.default_model())[0] == ""


def test_main_text(spark):
    rows = [(1, "u", "<nav><a href='/'>Menu here</a></nav><article><h1>Title of it</h1><p>One&nbsp;two,  three.</p><p>Four.</p></article><footer>&copy; x</footer>", 0), (2, None, None, 0), (None, "u", "", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {r.page_id: r.text for r in html_extract.main_text(df).collect()}
    assert got == {1: "Title of it One two, three. Four.", 2: "", None: ""}
    assert html_extract.main_text(df.limit(0)).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def brute_spans(text):
    def good(kind, value):
        digits = re.sub("[^0-9]", "", value)
        return kind == "email" or kind == "ip" and all(int(p) <= 255 for p in value.split(".")) or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m.group())]


def test_pii_base_spans(spark):
    rng = random.Random(4)
    bits = ["a.b@c.de", "x@y", "@", "é", "日", "+1 (706) 555-3138", "1.2.3.4", "1.2.3.4.5", "999.1.1.1", "0255.1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", " ", ".", "-", "12", "+", "a@b.c_d@e.fg", "b.com", "\n", "0" * 25, "+12345678901234567890"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(250)] + [None, "", "7" * 40000, "a" * 40000 + "@", "1 " * 20000, "+" * 3000]
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)] + [(None, texts[0], 1)], "doc_id long, text string, kind int")
    got = {r.doc_id: [(pii.KINDS[s.kind], s.first, s.end) for s in r.spans if s.kind < 4] for r in pii.find(df).collect()}
    for k, text in enumerate(texts):
        assert got[k] == brute_spans(text), text[:80] if text else text
    assert pii.find(df.limit(0)).count() == 0


def test_pii_terms_that_disclose(spark):
    texts = [f"Number {k}: agent zorblax wrote from spy@hq.org about plain things {w}" for k, w in enumerate(("one", "two", "six", "ten"))]
    texts += [f"plain things about the wrote from agent list {k}" for k in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find(df).collect()}
    terms = {df.where(f"doc_id = {k}").first().text[s.first : s.end] for k in range(4) for s in rows[k].spans if s.kind == 4}
    assert "zorblax" in terms and not terms & {"agent", "wrote", "from", "plain", "things"}
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[0] == texts[0].replace("zorblax", "").replace("spy@hq.org", "[email]").replace("Number", "") or "zorblax" not in clean[0]
    assert "spy@hq.org" not in clean[1] and clean[20] == texts[20]


def test_pii_copies_do_not_hide_a_term(spark):
    texts = [f"agent zorblax wrote from spy@hq.org about {w}" for w in ("one", "two", "six")]
    texts += [texts[0]] * 300 + [f"plain things about the list {k}" for k in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in pii.find(df).collect()}
    assert all("zorblax" in {s.value for s in rows[k] if s.kind == 4} for k in (0, 1, 2, 150))
    assert not any("about" in {s.value for s in spans} for spans in rows.values())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, want))


def slow_pii(rows):
    """Spans of each (doc_id, text), all four counts taken one by one."""
    letters = regex.compile(r"\p{L}+")
    near, mentions, spans = [], set(), {}
    for k, (_, text) in enumerate(rows):
        text = text or ""
        valid = {(kind, a, b) for kind, a, b in brute_spans(text)}
        spans[k] = {(pii.KINDS.index(kind), a, b) for kind, a, b in valid}
        for kind, pattern in PATTERNS.items():
            found = [m.span() for m in re.finditer(pattern, text)]
            for i, (a, b) in enumerate(found):
                if (kind, a, b) not in valid:
                    continue
                entity = (kind, text[a:b])
                mentions.add((entity, text))
                low = found[i - 1][1] if i else 0
                high = found[i + 1][0] if i + 1 < len(found) else len(text)
                for begin, end, cut_at in ((max(low, a - 64), a, a - 64 if a - low > 64 else None), (b, min(high, b + 64), b + 64 if high - b > 64 else None)):
                    for m in letters.finditer(text[begin:end]):
                        first, last = begin + m.start(), begin + m.end()
                        whole = cut_at is None or not (first == cut_at if cut_at < a else last == cut_at)
                        if last - first >= 3 and whole:
                            near.append((k, entity, m.group().lower(), first, last, text))
    texts = {t or "" for _, t in rows}
    with_term, with_entity, joint = {}, {}, {}
    for t in texts:
        for w in set(letters.findall(t.lower())):
            with_term[w] = with_term.get(w, 0) + 1
    for entity, _ in mentions:
        with_entity[entity] = with_entity.get(entity, 0) + 1
    for entity, term, text in {(e, w, t) for _, e, w, _, _, t in near}:
        joint[entity, term] = joint.get((entity, term), 0) + 1
    for k, entity, term, first, last, _ in near:
        n, c = joint[entity, term], with_entity[entity]
        content = math.log2(len(texts) / c)
        if n >= 3 and content > 0 and math.log2(n * len(texts) / (c * with_term[term])) >= 0.9 * content:
            spans[k].add((4, first, last))
    return [sorted(spans[k]) for k in range(len(rows))]


def test_pii_query_against_a_slow_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in QUERIES["op8_pii"](spark, SF).collect()}
    for (doc_id, _), spans in zip(rows, slow_pii(rows)):
        named = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans]
        base = [x for x, (k, _, _) in zip(named, spans) if k < 4]
        r = got[doc_id]
        assert r.spans == ",".join(named) and r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in spans) for i in range(4)]


def test_pii_terms_against_a_slow_version(spark):
    rng = random.Random(6)
    words = "agent zorblax wrote about the plain list of things äöü x1 to somebody".split()
    texts = []
    for k in range(120):
        own = rng.choices(words[2:], k=rng.randint(1, 30))
        if k % 4 == 0:
            own.insert(rng.randint(0, len(own)), rng.choice(["zorblax spy@hq.org", "spy@hq.org zorblax to", "10.0.0.7 agent", "spy@hq.org x1"]))
        texts.append(" ".join(own))
    rows = list(enumerate([*texts, *texts[:30], None, ""]))
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = {r.doc_id: [(s.kind, s.first, s.end) for s in r.spans] for r in found}
    want = slow_pii(rows)
    assert any(s[0] == 4 for spans in want for s in spans)
    assert all(got[k] == spans for k, spans in enumerate(want))


def test_extraction_query_against_single_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op7_html_extraction"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        text = html_extract.extract([pages[r.page_id].html or ""], html_extract.default_model())[0]
        assert (r.text, r.n_chars, r.url) == (text, len(text), pages[r.page_id].url)


def test_simhash_query_against_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    prints = []
    for _, text in rows:
        parts = [p for p in re.split(b"[\t-\r ]+", re.sub(b"[A-Z]", lambda m: m.group().lower(), (text or "").encode())) if p]
        grams = [b" ".join(parts[k : k + 4]) for k in range(max(1, len(parts) - 3))] if parts else []
        bits = np.zeros(64, int)
        for g in grams:
            bits += [xxhash.xxh64_intdigest(g, 42) >> b & 1 for b in range(64)]
        prints.append(sum(1 << b for b in range(64) if 2 * bits[b] > len(grams)))
    label = list(range(len(rows)))
    for _ in rows:
        for i, x in enumerate(prints):
            for j in range(i):
                if label[i] != label[j] and (x ^ prints[j]).bit_count() <= 4:
                    label = [min(label[i], label[j]) if v in (label[i], label[j]) else v for v in label]
        break
    least = {v: min(rows[k][0] for k in range(len(rows)) if label[k] == v) for v in set(label)}
    want = sorted((d, f"{p:016x}", least[v]) for (d, _), p, v in zip(rows, prints, label))
    assert sorted(map(tuple, QUERIES["op9_simhash_near_dedup"](spark, SF).select("doc_id", "fingerprint", "component_id").collect())) == want


def test_bpe_query_against_the_library(spark):
    import public_tokenizers
    import tiktoken

    from asofra.llm import byte_bpe

    ranks = byte_bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in QUERIES["op10_byte_bpe"](spark, SF).collect()}
    for doc_id, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = whole.encode_ordinary(text or "")
        r = got[doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_pii_terms_of_whole_texts(spark):
    """A term far from its entity is found and marked wherever it stands."""
    rng = random.Random(8)
    fill = lambda n: " ".join(rng.choices("plain words about the list of many things äöü".split(), k=n))
    texts = [f"Zorblax {fill(40)} 😀 {fill(30)} spy@hq.org {fill(60)} zorblax, {fill(k + 1)}" for k in range(4)]
    texts += [texts[0], f"spy@hq.org {fill(9)}", *(fill(50) for _ in range(60)), None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    letters, different = regex.compile(r"\p{L}+"), {t or "" for t in texts}
    words = {t: {w.lower() for w in letters.findall(t) if len(w) > 2} for t in different}
    held = [t for t in different if "spy@hq.org" in t]
    content, telling = math.log2(len(different) / len(held)), set()
    for term in set().union(*words.values()):
        joint, known = sum(term in words[t] for t in held), sum(term in words[t] for t in different)
        if joint >= 3 and math.log2(joint * len(different) / (len(held) * known)) >= 0.9 * content:
            telling.add(term)
    assert "zorblax" in telling and "plain" not in telling
    got = {r.doc_id: [(s.first, s.end) for s in r.spans if s.kind == 4] for r in pii.find(docs, context=None).collect()}
    for k, t in enumerate(texts):
        want = [m.span() for m in letters.finditer(t or "") if m.group().lower() in telling] if t in held else []
        assert got[k] == want
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert all("zorblax" not in clean[k].lower() for k in range(5))
    assert pii.find(docs.limit(0), context=None).count() == 0

"""The methods against brute force, exact round trips and held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rankweave.llm import fingerprint, html_blocks, html_crf, html_pages, packing, pii, quality, suffix_dedup, token_store, warc
from rankweave.llm.common import range_bounds, running_before, shingle_hashes
from rankweave.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_shingles_are_those_of_the_words():
    texts = ["A b  c d E f", "a B c d e\tf", "one two", "", " \n", "é x " * 9]
    hashes, first = shingle_hashes([t.encode() for t in texts])
    sets = [set(hashes[a:b].tolist()) for a, b in zip(first, first[1:])]
    assert sets[0] == sets[1] and [len(s) for s in sets] == [2, 2, 1, 0, 0, 2]


def test_running_sums_over_ranges(spark):
    rows = [(i, i % 3, i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, g int, v long").repartition(5)
    got = running_before(df, "k", {"before": "v"}, range_bounds(df, "k", 9), ("g",)).collect()
    assert all(r.before == sum(v for k, g, v in rows if g == r.g and k < r.k) for r in got) and len(got) == 500


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_cache_gives_the_tokenizers_ids(docs, name):
    held = Encoder(public_tokenizers.path(name))
    texts = [r.text or "" for r in docs.collect()]
    texts += ["", " a", "a  b", "a\n\nb", "\n", "a\tb c", "it's 12 34", "\x1c a", "\x01 \x02", "<|endoftext|> x", "é  x", "\x02a b"]
    assert held.encode(texts) == [held.whole(t) for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_plain_library(docs, name):
    from tokenizers import Tokenizer

    plain, held = Tokenizer.from_file(public_tokenizers.path(name)), Encoder(public_tokenizers.path(name))
    texts = [r.text or "" for r in docs.limit(50).collect()]
    for sign in ("<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof text|>"):
        texts += [sign, f"foo {sign} bar", f"foo{sign}bar", f"a\n{sign}\n{sign}{sign} b", f"{sign} foo", "foo <|endoftext bar"]
    got = [np.frombuffer(x, held.dtype).tolist() for x in held.encode(texts)]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_codec_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = (rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32)
        control, data = token_store.encode_ranks(ranks)
        assert len(control) == -(-n // 4) and (token_store.decode_ranks(control, data, n) == ranks).all()


def test_token_files_hold_the_ids(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    held = Encoder(path)
    got = {r.doc_id: r for r in token_store.read_tokens(spark, token_store.write_token_files(docs, path)).collect()}
    start = 0
    for r in docs.orderBy("doc_id").collect():
        ids = held.ids(held.whole(r.text or ""))
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_interval_expansion_against_brute_force():
    r = random.Random(3)
    for _ in range(150):
        length, base = r.choice([1, 2, 3, 5, 8]), bytes(r.choices(b"abc", k=60))
        texts = []
        for _ in range(r.randint(1, 6)):
            cuts = [r.randint(0, 50) for _ in range(r.randint(0, 5))]
            texts.append(b"".join(base[a:a + r.randint(0, 20)] + bytes(r.choices(b"abcdef", k=r.randint(0, 8))) for a in cuts))
        seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
        want = [[i for i in range(len(t) - length + 1) if seen[t[i:i + length]] > 1] for t in texts]
        assert [x.tolist() for x in suffix_dedup.repeats_in(texts, length)] == want


@pytest.mark.parametrize("most", [suffix_dedup.MOST_BLOCKS, 1])
def test_removed_bytes_against_brute_force(docs, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_BLOCKS", most)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    seen = Counter(t[i:i + 200] for t in texts.values() for i in range(len(t) - 199))
    for r in suffix_dedup.remove_repeats(docs, keep_text=True).collect():
        gone = np.zeros(len(texts[r.doc_id]), bool)
        for i in range(len(gone) - 199):
            if seen[texts[r.doc_id][i:i + 200]] > 1:
                gone[i:i + 200] = True
        assert r.kept == np.frombuffer(texts[r.doc_id], np.uint8)[~gone].tobytes() and r.n_removed == gone.sum()


@pytest.mark.parametrize("most", [suffix_dedup.MOST_BLOCKS, 1])
def test_equal_rows_in_two_chunks_give_all_their_blocks(spark, monkeypatch, most):
    met = suffix_dedup._met
    # In every second fragment the blocks of the later chunk come first.
    turned = lambda rows: sorted(rows, key=lambda x: x["chunk"], reverse=rows[0]["fragment"] % 2 > 0)
    monkeypatch.setattr(suffix_dedup, "_met", lambda rows: met(turned(rows)))
    monkeypatch.setattr(suffix_dedup, "MOST_BLOCKS", most)
    r = random.Random(11)
    made = lambda n: "".join(r.choices("abcdefghij ", k=n))
    rows = []
    for i in range(8):
        text, at = made(1500), 200 + 100 * i
        rows += [(None if i % 2 else i, text)] * 2 + [(100 + i, made(299) + "<" + text[at:at + 250] + ">" + made(299))]
    given = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string")
    got = {x.doc_id: x for x in suffix_dedup.remove_repeats(given, keep_text=True).collect()}
    for i in range(8):
        text = rows[3 * i + 2][1].encode()
        assert (got[100 + i].n_removed, got[100 + i].kept) == (250, text[:300] + text[550:])


def test_column_generation_reaches_the_least_number():
    sizes, demand = np.array([3, 5, 7]), np.array([30.0, 20.0, 10.0])
    patterns, times = packing.solve(sizes, demand, 15)
    assert np.allclose(patterns @ times, demand, atol=1e-3) and (sizes @ patterns <= 15).all()
    assert times.sum() == pytest.approx((sizes @ demand) / 15, rel=1e-2)
    plan = packing.plan_patterns({3: 30, 5: 20, 7: 10}, 15)
    assert plan.sequences <= 18


def test_packing_is_tight_and_whole(docs):
    held = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r.doc_id: held.ids(held.whole(r.text or "")) for r in docs.collect()}
    got = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    covered = Counter()
    for r in got:
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        covered[r.doc_id] += r.length
    assert covered == {k: len(v) for k, v in ids.items()}
    total = sum(covered.values())
    assert len({r.sequence_id for r in got}) * packing.LENGTH <= total * 1.04 + packing.LENGTH


def test_crf_on_pages_it_has_not_seen():
    model = html_crf.trained(150)
    right = count = 0
    for html, labels in html_pages.labelled_pages(100, seed=9):
        held = html_blocks.blocks(html)
        got = model.decode(html_crf.block_features(held))
        right, count = right + int((got == labels).sum()), count + len(labels)
    assert right / count > 0.97


def test_given_pages_give_their_article(spark):
    model = html_crf.trained()
    rows = spark.read.parquet(f"{SF}/pages.parquet").select("html").collect()
    for r in rows:
        body = r.html[r.html.index("<article>"):].split("</article>")[0]
        held = html_blocks.blocks("<body>" + body)
        assert html_crf.main_text(model, r.html) == "\n".join(b.text for b in held)


ARTICLE = "<article><h1>Tides</h1><p>The harbour fills twice a day &amp; empties again.</p></article>"


@pytest.mark.parametrize("head", [
    "<head><title>T</title><meta charset=utf-8><style>p {}</style>", "<head><script>var a = '<body>'</script>\n",
    "<head><title>T</title><noscript><link rel=x></noscript></head>", "<head>dropped<title>T</title></head>", "<head><title>T</title><!-- </head> -->",
])
@pytest.mark.parametrize("body", ["<body>", ""])
def test_a_head_ends_without_an_end_tag(head, body):
    got = [b.text for b in html_blocks.blocks(f"<html>{head}{body}{ARTICLE}</html>")]
    assert got == ["Tides", "The harbour fills twice a day & empties again."]


def test_text_straight_after_an_open_head_stays():
    assert [b.text for b in html_blocks.blocks("<head><title>T</title>some <b>bold</b> words")] == ["some bold words"]


@pytest.mark.parametrize("tag", "button svg object canvas audio video select math template noscript datalist iframe".split())
def test_hidden_elements_that_are_never_closed(tag):
    texts = lambda page: [b.text for b in html_blocks.blocks(page)]
    want = ["Tides", "The harbour fills twice a day & empties again."]
    assert texts(f"<div><{tag} class=a></div>{ARTICLE}") == want
    assert texts(f"{ARTICLE}<div><{tag}>never shown</{tag}></div>") == want
    if tag != "iframe":
        assert texts(f"<div><{tag}></div>{ARTICLE}<p><{tag}>never shown</{tag}></p>") == want
        assert texts(f"<p><{tag}>a<{tag}>b</{tag}>c</{tag}></p>{ARTICLE}") == want


@pytest.mark.parametrize("tag", ["script", "style", "textarea", "title"])
def test_texts_without_markup_reach_to_the_end(tag):
    assert [b.text for b in html_blocks.blocks(f"<p>before</p><{tag}>x {ARTICLE}")] == ["before"]


def test_quality_on_held_out_labels(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality.score(docs, quality.train(docs, labels)).withColumn("held", quality.is_held_out())
    held = scored.join(labels, "doc_id").where("held").collect()
    assert held and sum(r.predicted == r.quality for r in held) / len(held) > 0.9


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_boundaries_inside_payloads_are_no_records(spark, monkeypatch):
    monkeypatch.setattr(warc, "SPLIT_BYTES", 700)
    inner = warc.record(99, "u", b"inner payload " * 20, "00", None).decode()
    rows = [(i, f"http://h/{i}", (inner * (i % 4) if i % 2 else "WARC/1.1\r\n" * 30) + "text " * (i * 7 % 90)) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.payload_bytes for r in warc.read_archives(warc.write_archives(pages)).collect()}
    assert got == {i: len(h.encode()) for i, _, h in rows}


def test_sketches_estimate():
    r = random.Random(2)
    words = [str(i) for i in range(4000)]
    a, b = " ".join(words[:3000]), " ".join(words[1000:])
    x, y = fingerprint.sketches([a, b], k=512)
    assert fingerprint.resemblance(x, y, 512) == pytest.approx(0.5, abs=0.08)
    assert fingerprint.containment(x, y, 512) == pytest.approx(2 / 3, abs=0.08)
    assert fingerprint.distinct(x, 512) == pytest.approx(2996, rel=0.15)
    whole = fingerprint.sketches([" ".join(words)], k=512)[0]
    assert fingerprint.resemblance(fingerprint.merge(x, y, 512), whole, 512) == 1.0
    assert (fingerprint.decoded(fingerprint._encoded(x)) == x).all() and r


def test_merged_sketches_over_parts(spark):
    df = spark.createDataFrame([("a b c d e f",), ("d e f g h i",)], "text string")
    made = df.select(fingerprint.fingerprint(F.col("text")).alias("f")).agg(fingerprint.merged()("f").alias("f")).first().f
    want = fingerprint.merge(*fingerprint.sketches(["a b c d e f", "d e f g h i"]))
    assert (fingerprint.decoded(made) == want).all()


# The contract's patterns in their plain form.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_spans(text):
    def fits(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "phone":
            return 10 <= len(digits) <= 15
        if kind == "card":
            odd = [int(c) * 2 - 9 * (int(c) > 4) if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
            return 14 <= len(digits) <= 19 and sum(odd) % 10 == 0
        return True

    found = [(m.start(), n, m.end(), k) for n, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if fits(k, m.group())]
    return ",".join(f"{k}:{a}:{e}" for a, _, e, k in sorted(found))


def test_spans_against_plain_patterns(spark, docs):
    r = random.Random(4)
    rows = [(d.doc_id, d.text or "") for d in docs.collect()]
    parts = ["a@b.c", "@x.y.", "1.2.3.4", "999.1.1.1.7", "4111 1111 1111 1111", "4111-1111 11111111", "+1 (555) 010-99", "007.08.9.255", " ", "_d@e.f-", "é", "12", "-", ".", "+", "+44 20 7946 0958 1234"]
    rows += [(10**6 + i, "".join(r.choices(parts, k=r.randint(1, 12)))) for i in range(400)]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find_personal_data(given).select("doc_id", pii.listed(F.col("base")).alias("s"))
    got = {x.doc_id: x.s for x in found.collect()}
    assert all(got[i] == _plain_spans(t) for i, t in rows)


def test_addresses_with_zero_parts(spark):
    values = ["10.0.0.1", "0.0.0.0", "1.2.3.00", "192.168.0.7", "8.8.8.0", "000.0256.1.1", "0.0.0.256", "00.01.002.000255", "1.2.3.1000"]
    r = random.Random(6)
    rows = list(enumerate(values + ["".join(r.choices([*values, "1.2.3.4", " ", ".", "0", "a"], k=r.randint(2, 8))) for _ in range(200)]))
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {x.doc_id: x.s for x in found.select("doc_id", pii.listed(F.col("base")).alias("s")).collect()}
    assert [got[i] for i in range(5)] == [f"ip:0:{len(v)}" for v in values[:5]]
    assert all(got[i] == _plain_spans(t) for i, t in rows)


def test_a_term_that_always_stands_by_an_entity_is_found(spark):
    filler = "quartz basil candle meadow violin harbor lantern pepper".split()
    r = random.Random(8)
    rows = [(i, " ".join(r.choices(filler, k=30))) for i in range(200)]
    for i in range(200, 206):
        rows.append((i, " ".join(r.choices(filler, k=9)) + " Zanzibarov x.y@mail.example.com " + " ".join(r.choices(filler, k=9))))
    rows.append((206, "zanzibarov alone"))
    got = {x.doc_id: x.spans for x in pii.digest(pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got[206] == "term:0:10" and "term" in got[203] and not any("term" in got[i] for i in range(200))
    clean = pii.sanitised(spark.createDataFrame(rows, "doc_id long, text string"), pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")))
    text = clean.where("doc_id = 203").first().text
    assert "anzibarov" not in text and "[email]" in text and math.isclose(clean.count(), 207)


def test_terms_of_few_documents_and_of_copies_are_weighed(spark):
    filler = "quartz basil candle meadow violin harbor lantern pepper".split()
    r = random.Random(9)
    some = lambda n: " ".join(r.choices(filler, k=n))
    rows = [(i, some(30) + " juniper" * (i < 20)) for i in range(400)]
    rows += [(i, f"{some(9)} juniper Quillfeather q.f@mail.example.com {some(9)}") for i in (400, 401)]
    rows += [(i, "basil candle Ostrander and o.s@mail.example.com violin") for i in range(402, 442)] + [(442, "ostrander alone")]
    # A row twice is two documents.
    rows += [(443, "meadow Vandersloot v.d@mail.example.com harbor")] * 2
    # The 120 characters before the address begin inside a word of which the rest stands in other texts.
    rows += [(444, "x" * 30 + "sandal " + "." * 114 + "w.w@mail.example.com")] + [(445, "dal")]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find_personal_data(given)
    clean = {x.doc_id: x.text for x in pii.sanitised(given, found).collect()}
    assert not any(re.search("quillfeather|ostrander|vandersloot", t.lower()) for t in clean.values())
    assert all("juniper" in clean[i] for i in (0, 400, 401)) and clean[445] == "dal"
    assert all(clean[i] == t for i, t in rows[:400])

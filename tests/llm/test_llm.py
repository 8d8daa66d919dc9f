"""The operators of the subpackage against brute force, exact round trips and stated edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from fieldspark.llm import bpe, decontaminate, exact_dedup, jaccard_join, katz, langid, pii, sharding, toxicity, urlfilter
from fieldspark.llm.words import gram_hashes, hash_words

DOC = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "doc_id long, text string, digest string, s long, c long, n int, keep_id long, label string"
WORDS = [f"w{i}" for i in range(400)]
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (None, "one"), (None, None), (5, "Ünïcödé — 漢字 🙂\x00\x85  end"), (6, "a " * 30000), (6, "a " * 30000), (7, "x" * 3000)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice(WORDS) + "x"
    return " ".join(w)


def lower(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def split_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows = [(i, text_of(rng, rng.randint(3, 120))) for i in range(120)]
    for i in range(120, 220):
        rows.append((i, edited(rng, rows[rng.randrange(110)][1], rng.randint(0, 4))))
    base = text_of(rng, 150)
    rows += [(i, edited(rng, base, rng.randint(1, 3))) for i in range(220, 300)]
    rows += [(i, base) for i in range(300, 340)]
    return rows + [(900 + (i or 50), t) for i, t in ODD[:5]] + [(17, "repeated id with another text of its own")]


# Operator 1


@pytest.fixture(scope="module")
def tokens():
    path, pattern = bpe.default_vocabulary()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.codec(path, pattern).ranks, special_tokens={})


def test_bpe_equals_the_library_and_decodes(spark, tokens, corpus):
    rows = [*corpus[:60], *ODD, (8, "<|endoftext|>'ll 1234567 \r\n\r\n  tail  ")]
    got = bpe.round_trip(frame(spark, rows), *bpe.default_vocabulary()).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for i, t in rows:
        ids = tokens.encode_ordinary(t or "")
        want[i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())] += 1
    assert Counter(map(tuple, got)) == want


def test_bpe_encode_and_decode_are_inverse(spark):
    docs = frame(spark, ODD)
    where = bpe.default_vocabulary()
    back = bpe.decode(bpe.encode(docs, *where), *where).collect()
    assert Counter((r["doc_id"], bytes(r["decoded"])) for r in back) == Counter((i, (t or "").encode()) for i, t in ODD)


def test_bpe_rejects_unknown_ids():
    with pytest.raises(ValueError, match="vocabulary"):
        bpe.codec(*bpe.default_vocabulary()).decode([np.array([10**6])])


def test_bpe_contracts_neighbouring_words_apart(tokens):
    rng = random.Random(11)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for letters in ("a", "ab", "aé", "the", "0 z", "漢a") for _ in range(400)}
    c = bpe.Codec(*bpe.default_vocabulary())
    size, flat = c._contract([w.encode() for w in words])
    assert [flat[e - n : e].tolist() for n, e in zip(size.tolist(), np.cumsum(size).tolist(), strict=True)] == [tokens._encode_single_piece(w) for w in words]


def test_bpe_words_met_again_are_not_contracted_again(tokens):
    c = bpe.Codec(*bpe.default_vocabulary())
    c.limit = 100
    met, contract = Counter(), c._contract
    c._contract = lambda words: met.update(words) or contract(words)
    often = [f" zq{x}xj{y}" for x in "abcdef" for y in "abcdef"]
    for i in range(5):
        texts = ["".join(often) * 2, "".join(f" kw{''.join(chr(97 + int(d)) for d in str(1000 * i + j))}vq" for j in range(200))]
        assert [x.tolist() for x in c.encode(texts)] == [tokens.encode_ordinary(t) for t in texts]
        c.rest()
        assert len(c.known) <= 100
    assert {met[w.encode()] for w in often} == {1}


def test_bpe_learns_again_what_a_failed_task_left(tokens):
    c = bpe.Codec(*bpe.default_vocabulary())
    text, contract = " zqxj kwvq the zqxj", c._contract

    def fail(words):
        raise MemoryError

    c._contract = fail
    with pytest.raises(MemoryError):
        c.encode([text])
    c._contract = contract
    assert c.encode([text])[0].tolist() == tokens.encode_ordinary(text)


def test_bpe_decodes_in_order_whatever_order_rows_arrive_in(monkeypatch, tokens, corpus):
    c = bpe.Codec(*bpe.default_vocabulary())
    texts = ["", *(t or "" for _, t in corpus[:40]), ""]
    ids = [np.array(tokens.encode_ordinary(t), np.int32) for t in texts]
    monkeypatch.setattr(bpe, "TOKENS_PER_QUERY", 7)
    assert c.decode(ids) == [t.encode() for t in texts]
    monkeypatch.setattr(bpe, "TOKENS_PER_QUERY", 1000)
    assert bpe.DECODE_SQL.count("ORDER BY pos)") == 1
    monkeypatch.setattr(bpe, "DECODE_SQL", bpe.DECODE_SQL.replace("ORDER BY pos)", "ORDER BY hash(pos))"))
    assert c.decode(ids) == [t.encode() for t in texts]


def test_bpe_decodes_a_text_beyond_the_memory_of_one_query(tokens):
    some = np.array(tokens.encode_ordinary(" orenor thederst the end."), np.int32)
    n = 6_000_000 // len(some)
    assert bpe.Codec(*bpe.default_vocabulary()).decode([np.tile(some, n), some]) == [b" orenor thederst the end." * n, b" orenor thederst the end."]


# Operator 2


def test_shards_follow_the_key_law(spark):
    rows = [*((i, f"t{i % 50}") for i in range(3000)), *ODD]
    got = sharding.shard_documents(frame(spark, rows), sharding.Tree.even(24)).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24)
    assert set(by) == set(range(24)) and all(sorted(x) == list(range(len(x))) for x in by.values())
    assert max(map(len, by.values())) < 1.5 * len(rows) / 24
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want


def test_weights_move_rows_only_in_their_subtree(spark):
    keys = frame(spark, [(i, "") for i in range(4000)]).select(F.col("doc_id").cast("string").alias("__key"))
    a = sharding.Tree((((((0, 1.0), (1, 1.0)), ((2, 1.0), (3, 1.0))), (((4, 2.0), (5, 2.0)),))))
    b = sharding.Tree((((((0, 0.5), (1, 1.5)), ((2, 1.0), (3, 1.0))), (((4, 2.0), (5, 2.0)),))))
    moved = sharding.place(sharding.place(keys, a, out="x"), b, out="y").filter("x <> y").select("x", "y").distinct().collect()
    assert {(r["x"], r["y"]) for r in moved} == {(0, 1)}


# Operator 3


def test_language_identification(spark):
    rng = random.Random(2)
    sets = {"aa": "bado kilu meno rasi tovu".split(), "bb": "schtrein kropf waldung zuecht".split(), "cc": "eaux oueille fleur joie".split()}
    text = lambda k: " ".join(rng.choice(sets[k]) + rng.choice(["", "n", "s"]) for _ in range(rng.randint(4, 40)))
    rows = [(i, text(k := rng.choice("abc") * 2), k, "s", 1) for i in range(600)]
    docs = spark.createDataFrame(rows, DOC)
    trees = langid.Trees.fit(docs.filter("doc_id < 400"))
    got = {r["doc_id"]: r for r in langid.predict(docs.filter("doc_id >= 400"), trees).collect()}
    assert sum(got[i]["lang_pred"] == k for i, _, k, *_ in rows[400:]) >= 198
    odd = langid.predict(frame(spark, [*ODD, (9, "123 ...")]), trees).collect()
    assert {r["lang_pred"] for r in odd if r["doc_id"] in (1, 2, 3, 9)} == {"und"} and all(0 <= r["score"] <= 1 for r in odd)
    none = langid.predict(frame(spark, ODD), langid.Trees.fit(docs.limit(0))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


def test_code_lengths_are_those_of_a_probability():
    grams, n = np.unique(np.frombuffer(b"".join(b"\n\n\nabracadabra cabra"[i : i + 4] for i in range(17)), ">u4").astype(np.uint32), return_counts=True)
    classes, rows, bits = langid.Trees({"x": (grams, n.astype(float))}).expand()
    a = bits.shape[1]
    unseen = 256 - (a - 1)
    total = np.exp2(-bits[:, :-1, 0]).sum(axis=1) + unseen * np.exp2(-bits[:, -1, 0])
    assert np.allclose(total, 1, atol=1e-5)


# Operator 4


def test_url_parts_rules_and_reputation(spark):
    urls = ["http://A.Example.ORG/es/x?q", "https://example.org/en/12#t", "http://x.com/fr/1", "http://x.com/de/1", "mailto:x", None, "http://bad.net/1", "http://bad.net", "ftp://good.net/7/"]
    pages = [(i, u) for i, u in enumerate(urls)] + [(100 + i, f"http://bad.net/{i}") for i in range(60)] + [(300 + i, f"http://ok.net/{1000 + i}") for i in range(200)]
    labels = [(i, 0, 0) for i in range(60)] + [(1000 + i, 1, 0) for i in range(200)] + [(None, 0, 1), (5, None, None)]
    got = urlfilter.judge_pages(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    by = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()}
    assert by[0] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert by[1] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert by[2][2:] == ("com/fr/", "allow") and by[3][2:] == ("com/de/", "block")
    assert by[4][:3] == by[5][:3] == ("", "", None)
    assert by[6] == ("bad.net", "/1", None, "block") and by[300][3] == "allow" and len(by) == len(pages)
    assert urlfilter.judge_pages(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


# Operator 5


def test_toxicity_learns_from_positives_and_unlabelled():
    rng = random.Random(3)
    clean = lambda: text_of(rng, 40)
    toxic = lambda: clean() + " " + rng.choice(["vilest", "rotgut", "vilely"]) + " " + text_of(rng, 10)
    model = toxicity.fit_nnpu([toxic() for _ in range(200)], [toxic() if rng.random() < 0.1 else clean() for _ in range(1500)], 0.1)
    hits = sum(model.score(toxic()) >= 0.3 for _ in range(200))
    false = sum(model.score(clean()) >= 0.3 for _ in range(400))
    assert hits >= 190 and false <= 12
    assert toxicity.fit_nnpu([], ["x"], 0.1).score("anything") == pytest.approx(0.1)


def test_toxicity_tables(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in ODD], DOC)
    labels = spark.createDataFrame([(4, 1), (2, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit_tables(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.clean(docs, labels).columns == docs.columns


def test_toxicity_learns_from_whole_texts(spark):
    rng = random.Random(4)
    start = text_of(rng, 9000)
    rows = [(i, f"{start} {text_of(rng, 20)}{' vilest' if i % 5 == 0 else ''}") for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.train(frame(spark, rows), labels)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(frame(spark, rows), model).collect()}
    assert model.weights["vilest"] > 0 and all((x >= 0.3) == (i % 5 == 0) for i, x in scores.items())


def test_toxicity_learns_the_same_from_distinct_words(spark):
    rng = random.Random(6)
    odd = ["", "ΟΔΟΣ οδός İstanbul Straße STRASSE a_b 12x ﬁn 漢字 e\u0301 \U0001d400", "x" * 12000, "".join(map(chr, range(0xD800)))]
    texts = [*odd, *(text_of(rng, 3000) + " Vilest" * (i % 5 == 0) for i in range(300))]
    marked = [i for i, x in enumerate(texts) if x.endswith("Vilest")]
    labels = spark.createDataFrame([(i, int(i in marked)) for i in range(len(texts))], "doc_id long, toxic int")
    model = toxicity.train(frame(spark, enumerate(texts)), labels)
    whole = toxicity.fit_nnpu([texts[i] for i in marked], texts, len(marked) / len(texts))
    assert model.weights and [model.score(x) for x in texts] == pytest.approx([whole.score(x) for x in texts], abs=1e-6)


# Operator 6


def test_pseudonyms_are_valid_linked_and_keyed(spark):
    card, ip, phone = "4805476200170562", "24.50.146.129", "+1 (444) 555-4984"
    text = f"pay {card} now; call {phone}, from {ip} on 2024-02-29 or 31.12.2020. mail greks.95@mail8.example.com, GB82 WEST 1234 5698 7654 32, 123-45-6789"
    rows = [(1, text), (2, f"again {card}"), *ODD, (20, "4805476200170563 999.1.1.1 2023-02-29 666-45-6789 \x01M \x01")]
    got = pii.pseudonymise(frame(spark, rows), "k").collect()
    by = {r["doc_id"]: r for r in got}
    assert by[20]["text"] == rows[-1][1] and not by[20]["found"]
    first = [r for r in got if r["doc_id"] == 1 and r["found"]][0]
    found = {f["kind"]: f for f in first["found"]}
    assert set(found) == {"card", "phone", "ip", "date", "email", "iban", "ssn"}
    assert all(f["value"] != f["pseudonym"] and len(f["value"]) == len(f["pseudonym"]) for f in first["found"] if f["kind"] != "ip")
    assert not any(v in first["text"] for v in (card, ip, phone, "2024-02-29", "greks.95"))
    new = found["card"]["pseudonym"]
    digits = [int(c) for c in reversed(new)]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    assert [r["text"] for r in got if r["doc_id"] == 2 and r["found"]] == [f"again {new}"]
    other = pii.pseudonymise(frame(spark, [(2, card)]), "another").first()["text"]
    assert other != new


def test_values_inside_rejected_candidates_are_found(spark):
    card, more = "4805 4762 0017 0562", "4805476200170562"
    cases = [
        ("on 415-555-2671 2024-05-17 and", ["415-555-2671", "2024-05-17"]),
        ("415-555-2671 415-555-2672", ["415-555-2671", "415-555-2672"]),
        (f"sold {card} 12 items", [card]),
        ("at BE68 5390 0754 7034 IBAN", ["BE68 5390 0754 7034"]),
        ("BE68 5390 0754 7034 GB82 WEST 1234 5698 7654 32", ["BE68 5390 0754 7034", "GB82 WEST 1234 5698 7654 32"]),
        (f"12 {card} {card}, 1234 {more} 415-555-2671-2024-02-29", [card, card, more, "415-555-2671", "2024-02-29"]),
        ("5 415-555-2671", ["415-555-2671"]),
        (f"No{card} 12 items, 415-555-2671 {'1' * 50000} (415)555-2672", [card, "415-555-2671", "(415)555-2672"]),
        ("+44 20 7946 0958 2024-05-17", ["+44 20 7946 0958", "2024-05-17"]),
        ("(415) 555-2671 (415) 555-2672.", ["(415) 555-2671", "(415) 555-2672"]),
        (f"{card} 12@mail.example.com 415-555-2671 7@x.example.org", [card, "12@mail.example.com", "415-555-2671", "7@x.example.org"]),
        (" ".join(f"415-555-{i}" for i in range(2000, 2300)), [f"415-555-{i}" for i in range(2000, 2300)]),
        ("4805-4762 0017 0562", ["4805-4762 0017 0562"]),
        ("12 34 56 415-555-26 nothing 2023-02-29 12 x", []),
    ]
    got = {r["doc_id"]: r for r in pii.pseudonymise(frame(spark, [(i, t) for i, (t, _) in enumerate(cases)]), "k").collect()}
    for i, (text, want) in enumerate(cases):
        assert [f["value"] for f in got[i]["found"]] == want, text
        for f in got[i]["found"]:
            text = text.replace(f["value"], f["pseudonym"], 1)
        assert len(got[i]["text"]) == len(text) and not any(v in got[i]["text"] for v in want), text
        if len(want) < 5:
            assert got[i]["text"] == text


def test_feistel_is_a_permutation(spark):
    n = 7 * 11
    got = [r["x"] for r in spark.range(n).select(pii.feistel(F.col("id"), 7, 11, "k", "t").alias("x")).collect()]
    assert sorted(got) == list(range(n)) and got != list(range(n))


# Operator 7


def test_katz_equals_brute_force_and_sums_to_one(spark, corpus):
    rows = corpus[:250] + [(i, t) for i, t in ODD if i is not None and len(t or "") < 3000]
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    docs = frame(spark, rows).withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0)
    got = katz.score_documents(docs).collect()
    one, two, documents = Counter(), Counter(), 0
    for i, t in rows:
        if not held(i):
            w = [*split_words(t), "</s>"]
            documents += 1
            one.update(w)
            two.update(zip(["<s>", *w[:-1]], w, strict=True))
    n = sum(one.values())
    levels = [katz.Level.of([sum(v == r for v in c.values()) for r in range(1, 7)]) for c in (one, two)]
    d = lambda level, c: level.d[c] if c <= 5 else 1.0
    kept = sum(d(levels[0], v) * v for v in one.values())
    unknown = max(1 - kept / n, 0.5 / (n + 1))
    p1 = lambda w: d(levels[0], one[w]) * one[w] * (1 - unknown) / kept if w in one else unknown
    after = defaultdict(dict)
    for (h, w), v in two.items():
        if v >= katz.CUTOFF:
            after[h][w] = v

    def p(h, w):
        c, f = documents if h == "<s>" else one.get(h, 0), after.get(h, {})
        mass = sum(d(levels[1], v) * v for v in f.values())
        held_mass = max(1 - mass / c, 0.5 / (c + 1)) if mass else 1.0
        if w in f:
            return (1 - held_mass) / mass * d(levels[1], f[w]) * f[w]
        return held_mass / (1 - sum(map(p1, f))) * p1(w)

    for h in [*list(after)[:8], "<s>", "never seen"]:
        assert sum(p(h, w) for w in one) + p(h, "another unseen") == pytest.approx(1)
    want = defaultdict(list)
    for i, t in rows:
        w = [*split_words(t), "</s>"]
        want[i].append((held(i), len(w), sum(x in one for x in w), n, sum(np.log10((one.get(x, 0) + 0.1) / (n + 0.1 * (len(one) + 1))) for x in w), sum(np.log10(p(a, b)) for a, b in zip(["<s>", *w[:-1]], w, strict=True))))
    assert len(got) == len(rows)
    for r in got:
        assert any(tuple(r)[1:5] == x[:4] and r["base_score"] == pytest.approx(x[4]) and r["score"] == pytest.approx(x[5]) for x in want[r["doc_id"]])


def test_katz_keeps_pairs_seen_once(spark):
    rows = [(i, f"a b{i} c a") for i in range(6)] + [(10, "a b0"), (11, "a c")]
    got = katz.score_documents(frame(spark, rows).withColumn("held_out", F.col("doc_id") >= 10)).collect()
    score = {r["doc_id"]: r["score"] for r in got}
    # One: a 12, c 6, end 6, b0-b5 1; pairs: start-a 6, a-end 6, a-b(i) and b(i)-c once each. "a b0" ends with an unseen pair.
    one = katz.Level.of([6, 0, 0, 0, 0, 2])
    two = katz.Level.of([12, 0, 0, 0, 0, 3])
    kept = 30 - 6 * (1 - one.d[1])
    unknown = 1 - kept / 30
    p1 = lambda c: (one.d[c] if c <= 5 else 1.0) * c * (1 - unknown) / kept
    left = 6 * (1 - two.d[1]) / 12  # what the six pairs seen once leave after "a"
    pair = two.d[1] / 12  # p(b0 | a), which a model without them backs off
    alpha_b = (1 - two.d[1]) / (1 - p1(6))
    start = 1 - 0.5 / 7  # "a" alone follows the start, and gives up half a count's
    assert score[10] == pytest.approx(np.log10(start) + np.log10(pair) + np.log10(alpha_b * p1(6)))
    alpha_a = left / (1 - 6 * p1(1) - p1(6))
    alpha_c = (0.5 / 7) / (1 - p1(12))
    assert score[11] == pytest.approx(np.log10(start) + np.log10(alpha_a * p1(6)) + np.log10(alpha_c * p1(6)))


def test_katz_without_training_documents(spark):
    got = katz.score_documents(frame(spark, [(1, "a b"), (2, None)]).withColumn("held_out", F.lit(True))).collect()
    assert all(r["n_known"] == 0 and r["score"] == 0 and r["train_tokens"] == 0 for r in got)
    assert katz.score_documents(frame(spark, []).withColumn("held_out", F.lit(True))).count() == 0


# Operator 8


def test_exact_dedup(spark):
    rows = [(1, "Same"), (7, "sAME"), (3, "other"), (3, "other"), (None, "same"), (4, None), (9, ""), (5, "Ünï"), (6, "üNÏ")]
    docs = spark.createDataFrame([(i, t, "d", 1, 1, 1, 1, "x") for i, t in rows], CLASH)
    got = exact_dedup.deduplicate(docs).collect()
    kept = Counter(r["doc_id"] for r in got if r["kept"])
    assert kept == Counter([7, 3, 9, 5, 6])
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in got} >= {(1, 7, 3), (None, 7, 3), (3, 3, 2), (4, 9, 2)}
    assert sorted(r["doc_id"] for r in exact_dedup.keep_one(docs).collect()) == [3, 5, 6, 7, 9]
    assert exact_dedup.keep_one(docs).columns == docs.columns
    assert exact_dedup.deduplicate(docs.limit(0)).count() == 0


def test_digest_index_lives_on(spark):
    index = exact_dedup.DigestIndex(spark, "digest_index_test", 4)
    first = exact_dedup.deduplicate(frame(spark, [(1, "a"), (2, "b")]), index).collect()
    again = exact_dedup.deduplicate(frame(spark, [(5, "A"), (6, "c"), (7, "C")]), index).collect()
    assert sum(r["kept"] for r in first) == 2
    assert {r["doc_id"]: (r["kept"], r["fresh"], r["keep_id"]) for r in again} == {5: (False, False, 1), 6: (False, True, 7), 7: (True, True, 7)}
    assert index.read().count() == 3


def test_digest_index_admits_by_a_sort_merge_anti_join(spark):
    index = exact_dedup.DigestIndex(spark, "digest_index_plan", 4)
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(40)]), rng.choice("aAbBcdefg")) for _ in range(300)]
    got = exact_dedup.deduplicate(frame(spark, rows), index, 4).collect()
    largest, size = {}, Counter(lower(t) for _, t in rows)
    for i, t in rows:
        largest[lower(t)] = max(-1 if i is None else i, largest.get(lower(t), -1))
    names = {hashlib.sha256(t.encode()).digest(): t for t in size}
    assert all(r["keep_id"] == largest[names[bytes(r["digest"])]] and r["group_size"] == size[names[bytes(r["digest"])]] and r["fresh"] for r in got)
    assert Counter((names[bytes(r["digest"])], r["doc_id"]) for r in got if r["kept"]) == Counter(largest.items())
    batch = frame(spark, [(1, "new")]).select(exact_dedup.digest(F.col("text")).alias("digest"), F.col("doc_id").alias("keep_id"))
    plan = index.new(batch)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    index.drop()
    assert not index.exists()


# Operator 9


def test_leaks_are_found_and_nothing_else(spark):
    rng = random.Random(8)
    items = [(k, text_of(rng, rng.randint(12, 60))) for k in range(30)] + [(98, None), (99, "")]
    rows, planted = [], set()
    for i in range(150):
        body = text_of(rng, rng.randint(20, 200)).split()
        if i % 3 == 0:
            k = rng.randrange(30)
            at = rng.randrange(len(body))
            n = len(items[k][1].split())
            body[at:at] = edited(rng, items[k][1], rng.randint(0, n // 10)).split()
            planted.add((i, k))
        rows.append((i, " ".join(body)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(frame(spark, [*rows, *ODD[:6]]), bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    hashed = [hash_words(pa.array([t], pa.string()))[0] for _, t in items]
    true = set()
    for i, t in rows:
        x = hash_words(pa.array([t]))[0]
        for (k, _), w in zip(items, hashed, strict=True):
            if len(w) and decontaminate.best_match(w, x)[0] <= int(0.2 * len(w) + 1e-9):
                true.add((i, k))
    assert planted <= true and got <= true and len(got) >= 0.97 * len(true)
    left = decontaminate.without_leaks(frame(spark, rows), bench)
    assert {r["doc_id"] for r in left.collect()} == {i for i, _ in rows} - {i for i, _ in got}
    assert decontaminate.find_leaks(frame(spark, rows), bench.limit(0)).count() == 0


@pytest.mark.parametrize("length", [50, 300, 600])
def test_recall_holds_at_all_edits_and_lengths(length):
    rng = random.Random(length)
    found = leaks = 0
    for _ in range(40):
        item = [f"a{rng.randrange(3000)}" for _ in range(length)]
        copy = list(item)
        for _ in range(length // 5):
            at, kind = rng.randrange(len(copy)), rng.randrange(3)
            copy[at : at + (kind > 0)] = [] if kind == 1 else [f"z{rng.randrange(10**6)}"]
        text = [f"a{rng.randrange(3000)}" for _ in range(rng.randrange(1, 60))] + copy + ["x"] * 40
        a, b = (hash_words(pa.array([" ".join(t)]))[0] for t in (item, text))
        if decontaminate.best_match(a, b)[0] <= length // 5:
            leaks += 1
            found += bool(list(decontaminate.Items([1], [a], decontaminate.Settings()).search(b, np.array([0, len(b)]))))
    assert leaks == 40 and found >= 0.99 * leaks


# Operator 10


def brute_components(rows, k, num, den):
    sets = []
    for _, t in rows:
        w = split_words(t)
        sets.append(frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else (frozenset([tuple(w)]) if w else frozenset()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and den * both >= num * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return Counter((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize(("k", "num"), [(4, 85), (5, 80), (2, 60)])
def test_jaccard_components_equal_brute_force(spark, corpus, k, num):
    got = jaccard_join.join_documents(frame(spark, corpus), jaccard_join.Similarity(k, num, 100)).collect()
    assert Counter(map(tuple, got)) == brute_components(corpus, k, num, 100)


def test_jaccard_crowded_regions_equal_brute_force(spark, monkeypatch):
    """Root regions of more than two classes in blocks of three Voronoi regions, and few pivots to link members."""
    for name, value in {"CROWD": 2, "BLOCK": 3, "CELLS": 1, "ENTRIES": 50}.items():
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(8)
    rows = []
    for family in range(12):
        base = text_of(rng, 60)
        rows += [(100 * family + i, edited(rng, base, rng.randint(0, 3))) for i in range(12)]
        rows += [(100 * family + 50 + i, f"{base} {text_of(rng, rng.randint(5, 40))}") for i in range(4)]
    got = jaccard_join.join_documents(frame(spark, rows), jaccard_join.Similarity(3, 75, 100)).collect()
    assert Counter(map(tuple, got)) == brute_components(rows, 3, 75, 100)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_of_chains_and_stars(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)] + [(200, 201 + i) for i in range(20)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    want = {x: y for x, y in label.items() if any(x in e and e[0] != e[1] for e in edges)}
    got = jaccard_join.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["c"]: r["label"] for r in got} == want and len(got) == len(want)


def test_jaccard_edge_cases(spark):
    docs = spark.createDataFrame([(i, t, "d", 1, 1, 1, 1, "x") for i, t in ODD], CLASH)
    got = jaccard_join.join_documents(docs, jaccard_join.Similarity(4, 85, 100)).collect()
    by = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in got}
    assert by[None, 1] == 4 and by[4, 1] == 4 and by[2, 0] == 2 and by[None, 0] is None and len(got) == len(ODD)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7]
    assert jaccard_join.join_documents(docs.limit(0), jaccard_join.Similarity()).count() == 0


def test_shingles_of_words():
    words, offsets = hash_words(pa.array(["a B c", None, " a\x0bb ", "A b C"]))
    assert offsets.tolist() == [0, 3, 3, 5, 8] and (words[:3] == words[5:]).all()
    assert len(gram_hashes(words[:3], 4)) == 0 and gram_hashes(words[:3], 2)[0] == gram_hashes(words[3:5], 2)[0]


# Faults found by review


def test_dates_and_phones_keep_their_reading(spark):
    """Different dates and numbers have different pseudonyms, whichever order or country they are written for."""
    rng = random.Random(4)
    dates = {f"{rng.randint(1, 12):02d}/{rng.randint(1, 28):02d}/{rng.randint(1900, 2020)}" for _ in range(3000)}
    dates |= {f"{rng.randint(13, 28)}/{rng.randint(1, 12):02d}/{rng.randint(1900, 2020)}" for _ in range(3000)}
    phones = {f"+{rng.choice(['44', '49', '1', '7'])} {rng.randint(100, 999)} {rng.randint(0, 999):03d} {rng.randint(0, 9999):04d}" for _ in range(3000)}
    got = pii.pseudonymise(frame(spark, list(enumerate(sorted(dates | phones)))), "k").select(F.explode("found").alias("f")).select("f.*").collect()
    by = defaultdict(set)
    for r in got:
        by[r["kind"], r["pseudonym"]].add(r["value"])
        if r["kind"] == "date":
            assert (int(r["value"][:2]) > 12) == (int(r["pseudonym"][:2]) > 12)
    assert len(got) > 8000 and all(len(v) == 1 for v in by.values())


def test_pii_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a@b.org", "x", "y")], "doc_id long, text string, __parts string, __pairs string")
    r = pii.pseudonymise(docs, "k").first()
    assert (r["__parts"], r["__pairs"], r["found"][0]["value"]) == ("x", "y", "a@b.org") and r["text"] != "a@b.org"
    assert pii.pseudonymise(docs.limit(0), "k").count() == 0


def test_signs_that_are_no_letters_have_no_language(spark):
    docs = spark.createDataFrame([(1, "½ ²", "x"), (2, "①", "x"), (3, "Ⅷ", "x"), (4, "été", "x")], "doc_id long, text string, lang string")
    trees = langid.Trees.fit(spark.createDataFrame([(1, "le chat est en été", "fr"), (2, "the cat", "en")], "doc_id long, text string, lang string"))
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, trees).collect()}
    assert got == {1: "und", 2: "und", 3: "und", 4: "fr"}
    assert langid.predict(docs.limit(0), trees).count() == 0


def test_repeated_leaks_of_items_with_int_ids(spark):
    rng = random.Random(12)
    item, more = text_of(rng, 30), lambda: text_of(rng, 25)
    text = f"{more()} {item} {more()} {edited(rng, item, 2)} {item} {more()}"
    bench = spark.createDataFrame([(7, item, "z")], "item_id int, text string, doc_id string")
    got = decontaminate.find_leaks(frame(spark, [(1, text), (2, more())]), bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["start"] // 5, r["edits"]) for r in got) == [(1, 7, 5, 0), (1, 7, 16, 2), (1, 7, 22, 0)]


# Brute force of what SQL does not say


def test_shards_equal_a_descent_of_the_tree(spark):
    tree = sharding.Tree.even(7, 2, 2)
    unit = lambda key, node: (int(hashlib.md5(f"{key}/{node}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
    least = lambda key, nodes: min((-np.log(unit(key, name)) / w, i) for name, w, i in nodes)[1]

    def shard_of(key, tree):
        weigh = lambda racks: sum(w for rack in racks for _, w in rack)
        r = least(key, [(f"g{r}", weigh(region), r) for r, region in enumerate(tree.regions)])
        k = least(key, [(f"g{r}.{k}", weigh([rack]), k) for k, rack in enumerate(tree.regions[r])])
        return least(key, [(f"g{r}.{k}.{s}", w, s) for s, w in tree.regions[r][k]])

    rows = [(None if i == 9 else i * 37, f"text {i}" * (i % 4)) for i in range(300)]
    got = sharding.shard_documents(frame(spark, rows), tree).collect()
    assert len(got) == 300
    for r in got:
        key = "null" if r["doc_id"] is None else str(r["doc_id"])
        assert r["shard"] == shard_of(key, tree) and r["grown_shard"] == shard_of(key, tree.grown())


def test_code_lengths_equal_prediction_by_partial_matching(spark):
    """Escape C with exclusion, from order 3 down to 256 equal bytes, over counts that are kept as they were learned."""
    learned = {"en": ["the cat sat on the mat", "that hat"], "fr": ["le chat est la", "ça va"]}
    trees = langid.Trees.fit(spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate((k, t) for k, ts in learned.items() for t in ts)], "doc_id long, text string, lang string"))
    expanded = trees.expand()

    def bits(lang, text):
        counts = [defaultdict(Counter) for _ in range(4)]
        for gram, n in zip(*trees.counts[trees.langs.index(lang)], strict=True):
            b = int(gram).to_bytes(4, "big")
            for order in range(4):
                counts[order][b[3 - order : 3]][b[3]] += n
        data, total = b"\n" * 3 + text.encode(), 0.0
        for i in range(3, len(data)):
            seen, left = set(), 1.0
            for order in (3, 2, 1, 0):
                c = {s: n for s, n in counts[order][data[i - order : i]].items() if s not in seen}
                if not c:
                    continue
                if data[i] in c:
                    left *= c[data[i]] / (sum(c.values()) + len(c))
                    break
                left *= len(c) / (sum(c.values()) + len(c))
                seen |= c.keys()
            else:
                left /= 256 - len(seen)
            total -= np.log2(left)
        return total

    for text in ("the chat", "la mat ça", "ω", "that", "zzz cat\n"):
        want = [bits(k, text) for k in trees.langs]
        assert langid.code_lengths(text, *expanded) == pytest.approx(want, rel=1e-4)


def test_pseudonyms_equal_a_feistel_network(spark):
    key = "k"
    f = lambda kind, step, value: int(hashlib.sha256(f"{key}|{kind}|{step}|{value}".encode()).hexdigest()[:14], 16)

    def network(x, a, b, kind):
        left, right = divmod(x, b)
        for i in range(pii.ROUNDS):
            if i % 2 == 0:
                left = (left + f(kind, i, right) % a) % a
            else:
                right = (right + f(kind, i, left) % b) % b
        return left * b + right

    addresses = ["10.0.0.1", "192.168.255.7", "8.8.8.8"]
    phones = ["415-555-2671", "212-867-5309"]
    rows = [(i, f"see {v} there") for i, v in enumerate([*addresses, *phones])]
    got = {r["value"]: r["pseudonym"] for r in pii.pseudonymise(frame(spark, rows), key).select(F.explode("found").alias("f")).select("f.*").collect()}
    for v in addresses:
        x = network(int.from_bytes(bytes(map(int, v.split("."))), "big"), 65536, 65536, "ip")
        assert got[v] == ".".join(map(str, x.to_bytes(4, "big")))
    for v in phones:
        a, b, c = map(int, v.split("-"))
        x = network((a - 200) * 8_000_000 + (b - 200) * 10_000 + c, 800, 8_000_000, "phone")
        assert got[v] == f"{x // 8_000_000 + 200}-{x % 8_000_000 // 10_000 + 200}-{x % 10_000:04d}"


def test_operators_take_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(i, t, "d", 1, 1, 1, 1, "x") for i, t in ODD], CLASH)
    bench = spark.createDataFrame([(1, "one two three four five six seven eight", 1)], "item_id long, text string, start long")
    assert decontaminate.find_leaks(docs, bench).count() == 0 and decontaminate.without_leaks(docs, bench).columns == docs.columns
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0 and decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    labels = spark.createDataFrame([(1, 1, "q"), (4, 0, "q"), (None, 1, "q"), (5, None, "q")], "doc_id long, toxic int, text string")
    model = toxicity.train(docs, labels)
    assert toxicity.score(docs, model).count() == len(ODD) and toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.train(docs.limit(0), labels.limit(0)).score("x") == pytest.approx(0.5)
    empty = langid.Trees.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in langid.predict(docs, empty).collect()} == {"und"}

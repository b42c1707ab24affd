"""Operators that look at one text at a time."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from larder.llm import bpe, pii, quality, queries, secrets, toxicity
from larder.llm.tokens import ByteLevelEncoder

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
POOL = "aAéÉ'stΣσς İ½²Ⅷ́\x1c\x85\xa0 \n\t!?<|>_-9\U0001f600ßẞﬁK中​﻿"


def odd_texts(n=500):
    draw = random.Random(1)
    made = ["".join(draw.choice(POOL) for _ in range(draw.randrange(40))) for _ in range(n)]
    return made + ["", " ", "<|startoftext|>a<|endoftext|> b", "it's WE'LL", "x" * 900, "ab" * 400, "ΑΣ ΑΣ."]


# --- word BPE ---------------------------------------------------------------------------


def test_word_bpe_equals_the_library():
    own, library = bpe.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    for text in odd_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        code, decoded = own.encode(text)
        assert np.frombuffer(code, "<u4").tolist() == ids
        assert decoded.decode() == library.decode(ids, skip_special_tokens=False) == own.decode(code)


def test_array_and_heap_agree():
    own = bpe.WordEncoder(WORDS)
    draw = random.Random(2)
    for _ in range(200):
        parts = [own.ids[draw.choice("abcdeinrst")] for _ in range(draw.randrange(1, 60))]
        assert own.by_array(list(parts)) == own.by_heap(list(parts))


def test_held_results_survive_being_forgotten():
    held = bpe.Held(lambda k: k * 2, most=3)
    assert [held[i % 7] for i in range(50)] == [i % 7 * 2 for i in range(50)] and len(held) <= 4


def test_word_bpe_of_odd_documents(odd_documents, no_documents):
    rows = bpe.encoded(odd_documents, WORDS).collect()
    assert len(rows) == odd_documents.count() and bpe.encoded(no_documents, WORDS).collect() == []
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].n_tokens == by_id[3].n_tokens == by_id[4].n_tokens == 0 and by_id[2].decoded == ""
    assert by_id[1].decoded == by_id[7].decoded and by_id[6].n_tokens > 60_000 and by_id[6].score == "w"


def test_byte_level_equals_the_library():
    own, library = ByteLevelEncoder(BYTES), Tokenizer.from_file(BYTES)
    for text in odd_texts():
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


# --- secrets ----------------------------------------------------------------------------


def brute_base(text):
    """The base kinds straight from their definition."""
    assign = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def test_base_spans():
    draw = random.Random(3)
    bits = ["token", "api_key", "APIKEY", "secret", "=", ":", " ", '"', "AKIA", "A1B2C3D4", "abcdef01", "x", "é", "\U0001f600", "12"]
    for _ in range(3000):
        text = "".join(draw.choice(bits) for _ in range(draw.randrange(14)))
        assert secrets.base_spans(text) == brute_base(text)


def test_guess_costs_rank_values():
    ranks = secrets.dictionary(WORDS)
    cost = {v: secrets.guess_cost(v, ranks) for v in ("password", "aaaaaaaa", "qwertyuiop", "19900102", "x7Kp9vQ2mZ", "mL8$zQ1!vT0x")}
    assert cost["aaaaaaaa"] < cost["password"] < cost["qwertyuiop"] < 8 and cost["19900102"] < 8
    assert cost["x7Kp9vQ2mZ"] >= 8 and cost["mL8$zQ1!vT0x"] > cost["x7Kp9vQ2mZ"]
    assert secrets.guess_cost("z" * 5000, ranks) == 5000


def test_guess_cost_is_the_cheapest_segmentation():
    ranks = {"abc": 5, "bcd": 2, "cde": 9}

    def brute(value):
        best = len(value) * secrets.BRUTE
        parts = list(secrets.segments(value, ranks))

        def walk(at, cost, k, forced):
            nonlocal best
            if at == len(value):
                best = min(best, cost + float(np.log10(float(np.prod(np.arange(1, k + 1))))))
                return
            for i, j, c in parts:
                if i == at:
                    walk(j, cost + c, k + 1, False)
            if not forced:
                for j in range(at + 1, len(value) + 1):
                    walk(j, cost + (j - at) * secrets.BRUTE, k + 1, True)

        walk(0, 0.0, 0, False)
        return best

    draw = random.Random(4)
    for _ in range(60):
        value = "".join(draw.choice("abcde1") for _ in range(draw.randrange(1, 9)))
        assert secrets.guess_cost(value, ranks) == pytest.approx(brute(value))


def test_long_values_are_segmented():
    ranks = secrets.dictionary(WORDS)
    assert secrets.guess_cost("z" * 101, ranks) == pytest.approx(1 + np.log10(101))
    for guessable in ("*" * 150, "-" * 101, "ab" * 3000, "pass" * 100):
        assert secrets.guess_cost(guessable, ranks, 8.0) < 8
        assert secrets.guess_spans(f"login: {guessable}", ranks, 8.0) == []
    draw = random.Random(12)
    for n in (101, 20_000):
        value = "".join(draw.choice("bcdfghjkmpqrvwxzBCDFGHJKMPQRVWXZ234679") for _ in range(n))
        assert secrets.guess_spans(f"pin: {value}", ranks, 8.0) == [(5, 3, 5 + n)]
    for _ in range(300):  # a bound changes nothing below it
        value = "".join(draw.choice(["pass", "qwer", "zz", "1990", "x", "K", "7"]) for _ in range(draw.randrange(1, 9)))
        assert secrets.guess_cost(value, ranks, 8.0) == pytest.approx(min(8.0, secrets.guess_cost(value, ranks)))


def test_secrets_of_odd_documents(odd_documents, no_documents):
    rows = {r.doc_id: r for r in secrets.secrets(odd_documents, WORDS).collect()}
    assert rows[5].n_assign == 1 and rows[5].n_guess == 1 and rows[5].spans.startswith("assign:21:")
    assert rows[2].spans == rows[3].spans == "" and rows[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = secrets.redact(odd_documents, WORDS)
    assert clean.columns == odd_documents.columns and secrets.redact(no_documents, WORDS).collect() == []
    new = {r.doc_id: r for r in clean.collect()}
    assert "aB3dE5fG7" not in new[5].text and new[5].n_chars == len(new[5].text) and new[1].score == "x"


# --- quality ----------------------------------------------------------------------------


def figures(text):
    words = text.encode().split()
    words = [w.decode() for w in words]
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality_figures(spark, odd_documents, no_documents):
    draw = random.Random(5)
    texts = [" ".join(draw.choice("ab") for _ in range(draw.randrange(60))) for _ in range(150)]
    texts += ["\n".join(draw.choice(["a b.", "c", "", " ", "d|d"]) for _ in range(draw.randrange(30))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in quality.cleaned(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == figures(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
    rows = {r.doc_id: r for r in quality.cleaned(odd_documents).collect()}
    assert rows[2].n_words == 0 and rows[2].base_failed and not rows[2].kept and rows[6].n_repeat_words == 60_000
    assert quality.cleaned(no_documents).collect() == []


def test_lines_that_fail_go(spark):
    prose = "\n".join(f"This is line {i} of prose about matter {i * 7}, written with care." for i in range(6))
    dirty = prose + "\nHome | About | Contact\nPlease click here to sign in.\n" + prose.split("\n")[2] + "\n\nThe end."
    docs = spark.createDataFrame([(1, dirty, 5, "x"), (2, "Menu | Home\n" * 40 + "A line.", 5, "y")], "doc_id int, text string, n_chars int, kept string")
    row = quality.clean_documents(docs).collect()
    assert len(row) == 1 and row[0].text == prose + "\n\nThe end." and row[0].n_chars == len(row[0].text) and row[0].kept == "x"
    plan = quality.cleaned(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


# --- personal data ----------------------------------------------------------------------


def test_surrogates_keep_kind_format_and_coreference(spark, no_documents):
    texts = {
        1: "Mail Bob.7@Mail.example.com or +1 (017) 555-7713, see 10.2.3.4!",
        2: "bob.7@mail.example.com and +1 017-555-7713 / 4929 3483 8514 6306, 4929348385146306",
        3: "Dear Mrs. Smith and Mr John Miller, Frau Müller; 123-45-6789 DE89 3704 0044 0532 0130 00.",
        4: "no data: 3.14, v1.2.3 and 2024", 5: "", 6: None,
    }
    docs = spark.createDataFrame([(i, t, "k") for i, t in texts.items()], "doc_id bigint, text string, n_entities string")
    docs = docs.unionByName(docs)
    rows = pii.anonymized(docs, "secret").collect()
    assert len(rows) == 12
    new = {r.doc_id: r.text for r in rows}
    assert new[4] == texts[4] and new[5] == "" and new[6] is None
    for gone in ("ob.7", "555-7713", "10.2.3.4", "4929", "Smith", "Miller", "123-45", "3704"):
        assert not any(gone in (t or "") for t in new.values()), gone
    mail = re.search(r"\S+@\S+", new[1])[0]
    assert new[2].startswith(mail + " and ")
    phones = [re.sub(r"\D", "", re.search(r"\+1[ (\d)-]+\d", new[i])[0]) for i in (1, 2)]
    assert phones[0] == phones[1] and re.search(r"\+1 \(017\) \d{3}-\d{4}", new[1])
    cards = re.search(r"(\d{4} \d{4} \d{4} \d{4}), (\d{16})", new[2])
    assert cards[1].replace(" ", "") == cards[2]
    assert re.search(r"Mrs\. \w+ and Mr (?:%s) \w+," % "|".join(pii.MALE_NAMES), new[3])
    assert pii.anonymized(docs, "secret").exceptAll(pii.anonymized(docs, "secret")).isEmpty()
    assert pii.anonymized(no_documents, "k").collect() == []


def test_surrogates_of_distinct_entities_are_distinct(spark):
    values = [f"{a:03d}-{b:02d}-{c:04d}" for a in range(5) for b in range(10) for c in range(40)]
    phones = [f"+1 (017) 555-{i:04d}" for i in range(3000)]
    frame = spark.createDataFrame([(v,) for v in values + phones], "value string")
    rows = pii.surrogates(frame, "k").collect()
    assert len(rows) == len(values) + len(phones) == len({r.replacement for r in rows})
    assert not {r.replacement for r in rows} & set(values + phones)


def test_surrogates_in_a_crowded_space(spark):
    """6,000 of the 10,000 numbers there are, all 1,000 of another length, and one digit to change."""
    crowd = [f"+1{i:04d}" for i in range(6000)]
    frame = spark.createDataFrame([(v, "phone", v[1:]) for v in crowd], "value string, kind string, canonical string")
    found = {r.canonical: r.new for r in pii.in_crowds(frame, "k").collect()}
    assert len(found) == len(set(found.values())) == 6000
    assert all(new != old and new[0] == "1" and len(new) == 5 for old, new in found.items())
    assert len({abs(int(new) - int(old)) for old, new in found.items()}) > 2000  # no mere shift
    whole = [f"7{i:03d}" for i in range(1000)] + [f"9{i}" for i in range(10)]
    frame = spark.createDataFrame([("phone", v) for v in whole], "kind string, canonical string")
    every = {r.canonical: r.new for r in pii.in_crowds(frame, "k").collect()}
    assert sorted(every) == sorted(every.values()) == sorted(whole) and all(a != b for a, b in every.items())
    other = {r.canonical: r.new for r in pii.in_crowds(frame, "another key").collect()}
    assert other != every and sorted(other.values()) == sorted(whole)
    sparse = spark.createDataFrame([("phone", f"7{i:03d}") for i in range(200)], "kind string, canonical string")
    assert pii.in_crowds(sparse, "k").isEmpty()


def test_crowds_and_draws_together(spark):
    """The whole mapping ends, and is distinct, with crowded and roomy spaces side by side."""
    values = [f"+1 {i:03d} {j:03d}" for i in range(1) for j in range(900)] + [f"+49 30 5550{i:03d}" for i in range(50)]
    rows = pii.surrogates(spark.createDataFrame([(v,) for v in values], "value string"), "k").collect()
    assert len(rows) == len(values) == len({r.replacement for r in rows})
    assert all(r.value != r.replacement and len(r.value) == len(r.replacement) for r in rows)


def test_surrogates_run_no_python(odd_documents):
    plan = pii.anonymized(odd_documents, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- toxicity ---------------------------------------------------------------------------


def test_a_pair_of_terms_counts_where_each_alone_does_not(spark):
    draw = random.Random(6)
    rows, labels = [], []
    for i in range(1500):
        insult, group = draw.random() < 0.5, draw.random() < 0.5
        words = [f"w{chr(97 + draw.randrange(26))}{chr(97 + draw.randrange(26))}" for _ in range(12)]
        words += ["vile"] * insult + ["neighbours"] * group
        draw.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(insult and group)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = {r.doc_id: r for r in toxicity.scored(docs, known).collect()}
    held = [(found[i].predicted, y) for i, y in labels if found[i].held_out]
    assert len(held) > 200 and np.mean([p == y for p, y in held]) > 0.97


def test_held_out_labels_are_not_used(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    docs = spark.createDataFrame([(i, f"text {'bad' if i % 2 else 'good'} {i}") for i in range(100)], "doc_id bigint, text string")
    assert toxicity.scored(docs, labels).exceptAll(toxicity.scored(docs, flipped)).isEmpty()
    rows = toxicity.scored(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.scored(no_documents, labels).collect() == []
    assert {r.score < 1e-6 for r in toxicity.scored(docs, labels.limit(0)).collect()} == {True}


def test_toxicity_query_on_held_out_rows(spark, middle_dir):
    found = queries.QUERIES["op2_toxicity"](spark, middle_dir)
    truth = spark.read.parquet(f"{middle_dir}/labels.parquet").join(found, "doc_id").where("held_out").collect()
    clean = [r.predicted for r in truth if not r.toxic]
    toxic = [r.score for r in truth if r.toxic]
    plain = [r.score for r in truth if not r.toxic]
    assert np.mean(clean) < 0.05 and np.mean([(a > b) + (a == b) / 2 for a in toxic for b in plain]) > 0.75

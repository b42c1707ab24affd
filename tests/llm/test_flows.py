"""Operators on streams of tokens, neighbouring documents and conversations; the pipeline."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from larder.llm import chat, fingerprints, packing, queries, token_counts, toxicity
from larder.llm import quality, secrets
from larder.llm.common import read, written

BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


# --- packing ----------------------------------------------------------------------------


def test_patterns_use_all_demand_and_fit():
    draw = np.random.default_rng(1)
    for n, size in ((0, 16), (1, 16), (30, 16), (400, 32), (5000, 32)):
        demand = np.bincount(draw.integers(0, size, n), minlength=size)
        patterns = packing.patterns_for(demand, size)
        used = sum((np.array(p) * c for p, c in patterns), np.zeros(size, int))
        units = np.arange(1, size + 1)
        assert (used == demand).all() and all((np.array(p) * units).sum() <= size for p, _ in patterns)
        # The linear bound, plus what rounding may add: a sequence for each class.
        assert sum(c for _, c in patterns) <= (demand * units).sum() / size * 1.05 + size
        deal = packing.Deal(patterns) if patterns else None
        if deal:
            classes = np.repeat(np.arange(size), demand)
            ranks = np.concatenate([np.arange(d) for d in demand])
            sequences, slots = deal.place(classes, ranks)
            assert len(set(zip(sequences, slots, strict=True))) == n
            assert np.bincount(sequences, units[classes]).max() <= size


def test_best_pattern_equals_brute_force():
    draw = np.random.default_rng(2)
    for _ in range(20):
        prices = draw.uniform(0, 1, 7)

        def best(room, prices=prices):
            return max([0, *(prices[c] + best(room - c - 1) for c in range(min(room, 7)))])

        value, found = packing.best_pattern(prices, 7)
        assert value == pytest.approx(best(7)) and (found * np.arange(1, 8)).sum() <= 7


def check_packing(rows, texts, library, twice=None):
    """Every id lies in one piece; sequences are gapless and not too long. ``twice``: a repeated row."""
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(by_doc.pop(twice, [])) == (2 if twice else 0)
    for doc_id, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc.pop(doc_id), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert not by_doc


def test_packing_query(spark, small_dir, documents, library):
    rows = queries.QUERIES["op4_packing"](spark, small_dir).collect()
    check_packing(rows, {r.doc_id: r.text for r in documents.collect()}, library)
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert sum(used.values()) > 0.97 * 2048 * len(used)


def test_packing_of_odd_documents(odd_documents, no_documents, library):
    rows = packing.packed(odd_documents, BYTES).collect()
    once = odd_documents.where("doc_id is null or doc_id != 1")
    check_packing(rows, {r.doc_id: r.text for r in once.collect()}, library, twice=1)
    assert packing.packed(no_documents, BYTES).collect() == []
    totals = packing.padding(packing.packed(odd_documents, BYTES)).first()
    assert totals.tokens == sum(r.length for r in rows)


# --- token counts -----------------------------------------------------------------------


def test_documents_across_blocks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "GROUP", 3)
    draw = random.Random(3)
    for width in (2, 4):
        lengths = [draw.choice([0, 1, 2, 30]) for _ in range(60)]
        stream = [x for n in lengths for x in [*[draw.randrange(1, 99) for _ in range(n)], 0]] + [5, 6]
        data = np.array(stream, f"<u{width}")
        blocks = [("f", i, data[i * 7 : i * 7 + 7].tobytes()) for i in range(-(-len(data) // 7))]
        blocks += [("g", 0, np.array([0], f"<u{width}").tobytes()), ("h", 0, np.array([4], f"<u{width}").tobytes())]
        frame = spark.createDataFrame(blocks, "file string, block bigint, payload binary")
        rows = token_counts.documents_in(frame, 0, width).orderBy("file", "number").collect()
        mine = [r for r in rows if r.file == "f"]
        assert [r.n_tokens for r in mine] == [*lengths, 2] and [r.number for r in mine] == list(range(61))
        assert [r.start for r in mine] == [0, *np.cumsum(np.array(lengths) + 1).tolist()]
        assert [r.terminated for r in mine] == [True] * 60 + [False]
        assert [(r.n_tokens, r.terminated) for r in rows[61:]] == [(0, True), (1, False)]


def test_flat_files_are_read_by_ranges(spark, folder):
    import os

    os.makedirs(f"{folder}/flat")
    data = np.array([3, 1, 0, 0, 7, 7, 7, 7, 7, 0, 2], "<u2")
    data.tofile(f"{folder}/flat/a.bin")
    open(f"{folder}/flat/empty.bin", "w").close()
    blocks = token_counts.read_flat(spark, f"{folder}/flat", block_tokens=4)
    rows = token_counts.documents_in(blocks, 0).orderBy("number").collect()
    assert [(r.n_tokens, r.terminated) for r in rows] == [(2, True), (0, True), (5, True), (1, False)]


def test_token_counts(odd_documents, no_documents, spark, small_dir, documents, library):
    rows = token_counts.token_counts(odd_documents, BYTES, 50256).collect()
    counts = sorted((r.doc_id or 0, r.n_tokens) for r in rows)
    library.encode_special_tokens = True
    expected = [(r.doc_id or 0, len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in odd_documents.collect()]
    assert counts == sorted(expected)
    assert token_counts.token_counts(no_documents, BYTES, 50256).collect() == []
    found = {r.doc_id: r.n_tokens for r in queries.QUERIES["op1_token_counts"](spark, small_dir).collect()}
    assert found == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in documents.collect()}
    library.encode_special_tokens = False


# --- fingerprints -----------------------------------------------------------------------


def test_fingerprints_do_not_depend_on_their_company():
    draw = random.Random(4)
    texts = ["".join(draw.choice("abcdefgh é") for _ in range(draw.choice([0, 1, 5, 300, 4000]))) for _ in range(40)]
    together = fingerprints.fingerprints(texts)
    assert together == [fingerprints.fingerprints([t])[0] for t in texts]


def walked(text: str) -> str:
    """The walk, one step at a time."""
    level, pointer, out, j = fingerprints.level_of(len(text)), 0, "", 0
    bits, hashed = fingerprints.moves(), fingerprints.nibbles()
    while pointer < len(text):
        letter = ord(text[pointer]) % (fingerprints.LETTERS - 1) + 1
        if fingerprints.levels(j, 1)[0] >= level:
            out += f"{hashed[(letter + 7 * j) % fingerprints.LETTERS]:x}"
        pointer += bits[j % fingerprints.TURNS, letter]
        j += 1
    return f"{level}:{out}"


def test_fingerprints_equal_the_plain_walk():
    draw = random.Random(5)
    for n in (0, 1, 2, 63, 64, 65, 700, 3000):
        text = "".join(draw.choice("abc éδ中\U0001f600") for _ in range(n))
        assert fingerprints.fingerprints([text, "other"])[0] == walked(text)


def test_likeness():
    draw = random.Random(6)
    base = "".join(draw.choice("abcdefghij ") for _ in range(3000))
    near = [base[:i] + "#" + base[i + 1 :] for i in range(0, 3000, 300)]
    far = ["".join(draw.sample(base, len(base))) for _ in range(10)]
    own, *rest = fingerprints.fingerprints([base, *near, *far])
    like = [fingerprints.likeness(own, x) for x in rest]
    assert np.mean(like[:10]) > 0.7 and max(like[10:]) < 0.4
    assert fingerprints.likeness("0:", "0:") == 1 and fingerprints.likeness("0:", "0:a") == 0
    long, short = fingerprints.fingerprints([base[:1100], base[:1000]])
    assert long[0] != short[0] and fingerprints.likeness(long, short) > 0.7  # levels differ


def test_neighbours_over_partitions(spark, small_dir, documents):
    texts = [r.text for r in documents.orderBy("doc_id").collect()]
    rows = queries.QUERIES["op10_fingerprints"](spark, small_dir).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    prints = fingerprints.fingerprints(texts)
    for i, (r, text) in enumerate(zip(rows, texts, strict=True)):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest() and r.n_chars == len(text)
        assert r.fingerprint == prints[i] and r.near_next == fingerprints.likeness(prints[i], prints[(i + 1) % len(texts)])
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.95


def test_fingerprints_of_odd_documents(odd_documents, no_documents):
    rows = fingerprints.with_next(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert len({r.fingerprint for r in rows if r.n_chars == 49}) == 1
    assert {r.fingerprint for r in rows if r.doc_id in (2, 3)} == {"0:"}
    assert fingerprints.with_next(no_documents).collect() == []
    one = fingerprints.with_next(odd_documents.where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_near_groups_equal_brute_force(spark):
    draw = random.Random(7)
    base = "".join(draw.choice("abcdefghij ") for _ in range(2000))
    texts = {1: base, 2: base, 3: base[:-5] + "xxxxx", 4: "".join(draw.sample(base, len(base))), 5: "", 6: "", 7: "ab", 8: "ab c"}
    for i in range(10, 60):  # a crowd around one text
        at = draw.randrange(1000, 1990)
        texts[i] = base[:at] + draw.choice("xyz") + base[at + draw.randrange(2) :]
    prints = dict(zip(texts, fingerprints.fingerprints(list(texts.values())), strict=True))
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in prints:
        for b in prints:
            if a < b and fingerprints.likeness(prints[a], prints[b]) >= 0.8:
                root[max(find(a), find(b))] = min(find(a), find(b))
    frame = spark.createDataFrame([*prints.items(), (None, "0:")], "doc_id bigint, fingerprint string")
    for small in (2, 32):
        found = {r.doc_id: r.group_id for r in fingerprints.near_groups(frame, small=small).collect()}
        assert found.pop(None) is None and found == {i: find(i) for i in prints}
    assert fingerprints.near_groups(frame.limit(0)).collect() == []


def grouped_by_all_pairs(prints):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in prints:
        for b in prints:
            if a < b and fingerprints.likeness(prints[a], prints[b]) >= 0.8:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in prints}


def test_near_groups_see_edits_anywhere_and_across_levels(spark):
    draw = random.Random(9)

    def words(n):
        return "".join(draw.choice("abcdefghij ") for _ in range(n))

    texts = []
    for _ in range(12):  # at the head, at the boundaries of levels, and of short texts
        base = words(2000)
        texts += [base, words(280) + base[280:], words(120) + base[150:]]
        for edge in (128, 256, 1024):
            base = words(edge)
            texts += [base[:-1], base, base + "x"]
        for n in (6, 9, 14, 25, 40):
            base = words(n)
            texts += [base, base[:-1] + "#", base + "#"]
    prints = dict(enumerate(fingerprints.fingerprints(texts), 1))
    # Samples changed at the head of a print, which no later place can tell.
    for n in (5, 10, 23, 64, 130, 250):
        for _ in range(6):
            own = [draw.choice("0123456789abcdef") for _ in range(n)]
            spoiled = [draw.choice("ghijk") if i < n * 3 // 20 or i == 0 else x for i, x in enumerate(own)]
            for samples in (own, spoiled):
                prints[len(prints) + 1] = f"{0 if n < 128 else 4}:" + "".join(samples)
    expected = grouped_by_all_pairs(prints)
    assert sum(i != g for i, g in expected.items()) > 120
    frame = spark.createDataFrame([*prints.items()], "doc_id bigint, fingerprint string")
    assert {r.doc_id: r.group_id for r in fingerprints.near_groups(frame).collect()} == expected


def edited_texts(seed, count):
    """Prose-like texts of many lengths, each followed by copies with more and more edits."""
    draw, out = random.Random(seed), []
    words = ["".join(draw.choice("etaoinshrdlu") for _ in range(draw.randrange(2, 9))) for _ in range(900)]
    for _ in range(count):
        text = " ".join(draw.choice(words) for _ in range(draw.choice([3, 12, 60, 300, 900])))
        out.append(text)
        for share in (0.002, 0.01, 0.02, 0.04):
            letters = list(text)
            for _ in range(max(1, int(share * len(letters)))):
                letters[draw.randrange(len(letters))] = draw.choice(["", "xx", "q"])
            out.append("".join(letters))
    return out


def test_blocks_of_prints_equal_single_comparisons():
    prints = [*fingerprints.fingerprints(edited_texts(2, 12)), "0:", "0:", "3:ab"]
    left, right = prints[::3], prints[1::2] + ["0:"]
    found = fingerprints.like_blocks(left, right, 0.8)
    assert found.tolist() == [[fingerprints.likeness(a, b) >= 0.8 for b in right] for a in left]


def test_short_signatures_lose_no_near_pair():
    """Near pairs agree in some band, and whatever does passes the signatures."""
    prints = fingerprints.fingerprints(edited_texts(4, 40))
    bands, width = fingerprints.banding(len(prints), 0.8)
    assert (bands, width) == (33, 7) and fingerprints.banding(10**9, 0.8)[1] == 12
    keys = []
    for p in prints:
        short = {at: s for at, *s in fingerprints.signatures(p, 0.8)}
        keys.append({k: short[k % 32] for k in fingerprints.bucket_keys(p, 0.8, bands, width).tolist()})
    near = [(a, b) for a in range(len(prints)) for b in range(a) if fingerprints.likeness(prints[a], prints[b]) >= 0.8]

    def differing(one, two):
        n = min(one[2], two[2])
        mask = (1 << n) - 1
        values = [(low % 2**64) | (high % 2**64) << 64 for low, high, _ in (one, two)]
        return ((values[0] ^ values[1]) & mask).bit_count() <= fingerprints.MOST_DIFFERING * n + fingerprints.SLACK

    met = [(a, b) for a, b in near if keys[a].keys() & keys[b].keys() or prints[a] == prints[b]]
    assert len(near) > 60 and len(met) >= 0.98 * len(near)
    for a, b in met:
        common = keys[a].keys() & keys[b].keys()
        assert prints[a] == prints[b] or any(differing(keys[a][k], keys[b][k]) for k in common)


def test_signatures_in_spark_terms(spark):
    draw = random.Random(5)
    rows = [tuple(draw.getrandbits(64) - 2**63 for _ in range(4)) + (draw.randrange(1, 129), draw.randrange(1, 129)) for _ in range(300)]
    rows += [(a, b, a ^ (1 << draw.randrange(62)), b, n, m) for a, b, _, _, n, m in rows]
    frame = spark.createDataFrame(rows, "low bigint, high bigint, low_b bigint, high_b bigint, count bigint, count_b bigint")
    found = [r[0] for r in frame.selectExpr(fingerprints.signatures_alike("", "_b")).collect()]
    for (low, high, low_b, high_b, n, m), alike in zip(rows, found, strict=True):
        count = min(n, m)
        one, two = (x % 2**64 | (y % 2**64) << 64 for x, y in ((low, high), (low_b, high_b)))
        differing = ((one ^ two) & ((1 << count) - 1)).bit_count()
        assert alike == (differing <= fingerprints.MOST_DIFFERING * count + fingerprints.SLACK)


def test_fingerprint_query_has_near_groups(spark, small_dir):
    rows = queries.QUERIES["op10_fingerprints"](spark, small_dir).collect()
    assert {r.doc_id: r.group_id for r in rows} == grouped_by_all_pairs({r.doc_id: r.fingerprint for r in rows})


# --- chat -------------------------------------------------------------------------------


def test_chats_are_read_back(spark):
    draw = random.Random(8)
    bits = ["<turn>", "</turn>", "<text>", "<part>", "&lt;", "&", "amp;", "\\", "\n", "x", "é\U0001f600", "### Assistant:", ""]
    rows = []
    for conv in range(60):
        for turn in range(draw.randrange(1, 12)):
            text = "".join(draw.choice(bits) for _ in range(draw.randrange(6)))
            rows.append((conv, turn, draw.choice(["user", "assistant", "sys<tem", ""]), text, "extra"))
    rows += [(100, None, None, None, "e"), (100, 1, "assistant", None, "e"), (None, 1, "assistant", "a", "e"), (100, 1, "assistant", None, "e")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string")
    made = chat.formatted(frame)
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    expected = {}
    for conv, turn, role, text, _ in rows:
        expected.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert set(back) == set(expected)
    for conv, turns in expected.items():
        turns = sorted(turns)
        assert [(t.role, t.text) for t in back[conv].turns] == [(r, t) for _, r, t in turns]
        assert back[conv].loss_text == "".join(t for _, r, t in turns if r == "assistant")
    for r in made.collect():
        assert "".join(s.piece for s in r.segments) == r.formatted
        turns = sorted(expected[r.conv_id])
        blocks = sum(i == 0 or turns[i - 1][1] != t[1] for i, t in enumerate(turns))
        assert r.formatted.count("<turn>") == r.formatted.count("</turn>") == blocks
    assert chat.read_back(chat.formatted(frame.limit(0))).collect() == []
    plan = chat.read_back(made)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


# --- pipeline ---------------------------------------------------------------------------


def test_pipeline_stages(spark, middle_dir, library):
    docs = read(spark, middle_dir, "documents")
    labels = read(spark, middle_dir, "labels")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, before, middle_dir), "test")
        assert after.columns == columns and after.dtypes == docs.dtypes
        old, new = ({r.doc_id: r.text for r in frame.collect()} for frame in (before, after))
        assert set(new) <= set(old)
        if name == "toxicity":
            rows = toxicity.scored(before, labels).where("predicted = 0").collect()
            assert set(new) == {r.doc_id for r in rows}
        elif name == "quality_rules":
            kept = {r.doc_id: r.clean_text for r in quality.cleaned(before).where("kept").collect()}
            assert new == kept
        elif name == "near_duplicates":
            from .test_minhash import brute

            assert set(new) == {i for i, (_, component) in brute(old, 5).items() if i == component}
        else:
            ranks = secrets.dictionary(public_tokenizers.path("word_bpe_49k.json"))
            for i, text in old.items():
                spans = secrets.base_spans(text) + secrets.guess_spans(text, ranks, 8.0)
                assert new[i] == secrets.redacted(text, spans)
        before = after
    rows = corpus_pipeline.run(spark, middle_dir).collect()
    check_packing(rows, {r.doc_id: r.text for r in before.collect()}, library)


def test_pipeline_of_odd_documents(spark, small_dir, odd_documents):
    for docs in (odd_documents, odd_documents.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, small_dir), "test")
            if name != "packing":
                assert docs.columns == odd_documents.columns

"""Sharding, packing, token files, the two classifiers and page extraction."""

import random
import re
import time
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from odolake.llm import (
    best_fit_packing, html_extraction, quality_classifier, sharding, token_files, tokens, toxicity,
)
from odolake.llm.dom import read

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
TEXTS = [None, "", " ", "one", "one", "it's 3 o'clock, isn't it?", "ÄÖÜ straße\n\nnaïve", "漢字 and <|endoftext|>", "a  b\t\r\n c",
         "word " * 6000, "İstanbul Ünal", "can't stop... ́x", "ends with space ", "Ꜳ ｆｕｌｌ"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING")


@cache
def tokenizer(path):
    return Tokenizer.from_file(path)


def whole(path, text):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids


# --- sharding -----------------------------------------------------------------


def least_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, room = (low + high) // 2, 1, (low + high) // 2
        for s in sizes:
            if s > room:
                used, room = used + 1, middle
            room -= s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize(("n", "shards", "index"), [(300, 7, 15), (200, 40, 10), (5, 8, 100), (400, 3, 4)])
def test_sharding_is_minimax(spark, n, shards, index):
    r = random.Random(n)
    rows = [(k, "x" * (int(r.paretovariate(0.7) * 3) % 3000) + str(r.randrange(n))) for k in range(n)] + [(None, None), (3, "3")]
    docs = frame(spark, rows)
    key = sharding.text_key(sharding.F.col("text"))
    groups = docs.groupBy(key.alias("key")).agg(
        sharding.F.sum(sharding.F.coalesce(sharding.F.octet_length("text"), sharding.F.lit(0)) + 16).alias("size"))
    want = least_capacity([g["size"] for g in groups.orderBy("key").collect()], shards)
    placed = sharding.running(groups, ["size"])
    assert sharding.smallest_capacity(placed, shards, index)[0] == want
    out = sharding.shard(docs, shards).collect()
    assert len(out) == len(rows)
    fill, slots = Counter(), defaultdict(list)
    for x in out:
        fill[x.shard] += x.size
        slots[x.shard].append(x.slot)
    assert max(fill.values()) == want and set(fill) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    shards_of = defaultdict(set)
    texts = {k: t for k, t in rows[:n]}
    for x in out:
        if x.doc_id is not None:
            shards_of[x.text_crc32, x.size].add(x.shard)
            assert x.text_crc32 in (zlib.crc32(texts[x.doc_id].encode()), zlib.crc32(b"3"))
    assert all(len(v) == 1 for v in shards_of.values())


def squares(sizes, shards, capacity):
    """The least sum of squared shard sizes under a capacity, by trying every cut."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    best = {0: 0}
    for _ in range(shards):
        best = {t: min(best[i] + (ends[t] - ends[i]) ** 2 for i in best if i <= t and ends[t] - ends[i] <= capacity)
                for t in range(len(ends)) if any(i <= t and ends[t] - ends[i] <= capacity for i in best)}
    return best[len(sizes)]


def test_cuts_under_the_capacity_are_the_most_even():
    r = random.Random(6)
    for _ in range(60):
        sizes = [int(r.paretovariate(0.8) * 5) for _ in range(r.randint(1, 40))]
        shards = r.randint(1, 12)
        capacity = least_capacity(sizes, shards)
        cuts = sharding.Places(np.cumsum(sizes), np.zeros(len(sizes), bool)).even(capacity, shards)
        fills = np.diff([0, *cuts])
        assert len(cuts) == shards and cuts[-1] == sum(sizes) and fills.min() >= 0 and fills.max() <= capacity
        assert (fills ** 2).sum() == squares(sizes, shards, capacity)
        assert np.count_nonzero(fills) == min(shards, len(sizes)) and 0 not in fills[:np.count_nonzero(fills)]


@pytest.mark.parametrize("times", [1.5, 2, 20, 2000])
def test_a_hot_group_leaves_no_shard_empty(spark, times):
    n, shards = 4000, 40
    copies = int(times * n / (shards - times)) if times < shards / 2 else int(times * n)
    rows = [(k, f"{k:032}") for k in range(n)] + [(n + k, "y" * 32) for k in range(copies)]
    fill = Counter()
    for x in sharding.shard(frame(spark, rows), shards).collect():
        fill[x.shard] += x.size
    *others, hot = sorted(fill.values())
    assert len(fill) == shards and hot == 48 * copies  # as small as it can be
    average = 48 * n / (shards - 1)
    assert 0.9 * average < others[0] and others[-1] < 1.1 * average


def test_sharding_edges(spark):
    assert sharding.shard(frame(spark, [])).count() == 0
    assert [x.shard for x in sharding.shard(frame(spark, [(1, None)] * 3), 2).collect()] == [0, 0, 0]


# --- tokens, packing, files ---------------------------------------------------


@pytest.mark.parametrize(("path", "pattern"), [(BYTES, tokens.BYTE_LEVEL), (WORDS, tokens.WORD_LEVEL)], ids=["bytes", "words"])
def test_encoder_equals_the_tokenizer(path, pattern):
    r = random.Random(2)
    parts = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", "\x1c", "\xa0", "1", "23", "'s", "'", "!", "...", "Σ", "́", "漢", "İ", "µ"]
    texts = TEXTS + ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(1500)]
    encode = tokens.Encoder(path, pattern, "<u4")
    for t, ids in zip(texts, encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole(path, t), ascii(t)


def test_packing(spark):
    r = random.Random(3)
    rows = list(enumerate(TEXTS)) + [(k, " ".join(r.choice("abcdefgh") for _ in range(r.randint(0, 90)))) for k in range(20, 300)]
    rows += [(21, "again")] * 3
    out = best_fit_packing.pack(frame(spark, rows).repartition(5), WORDS, capacity=64, slack=1).collect()
    want = Counter()
    total = 0
    for d, t in rows:
        ids = [*whole(WORDS, t), 0]
        total += len(ids)
        for a in range(0, len(ids), 64):
            part = np.array(ids[a:a + 64], "<u4")
            want[d, a // 64, a, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in out) == want
    sequences = defaultdict(list)
    for x in out:
        sequences[x.sequence_id].append((x.offset, x.length))
    for places in sequences.values():
        places.sort()
        assert [a for a, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1]] and sum(n for _, n in places) <= 64
    assert len(sequences) <= -(-total // 64) * 1.05 + 1
    assert best_fit_packing.pack(frame(spark, []), WORDS).count() == 0


def fills(out):
    total = Counter()
    for x in out:
        total[x.sequence_id] += x.length
    return sorted(total.values())


def test_packing_does_not_depend_on_the_order_of_lengths(spark, monkeypatch):
    monkeypatch.setattr(best_fit_packing, "DEALT", 100)
    rows = [(k, "a " * (39 if k < 300 else 19)) for k in range(600)]  # with the end 40 and 20 ids
    out = best_fit_packing.pack(frame(spark, rows).repartitionByRange(6, "doc_id"), WORDS, capacity=64, slack=1).collect()
    assert len(out) == 600 and len(fills(out)) <= 315  # 300 would do; 400 if the lengths never meet


@pytest.mark.parametrize(("dealt", "block"), [(3, 200_000), (10, 8)])
def test_no_two_underfull_bins_fit_together(spark, monkeypatch, dealt, block):
    monkeypatch.setattr(best_fit_packing, "DEALT", dealt)
    monkeypatch.setattr(best_fit_packing, "BLOCK", block)
    r = random.Random(9)
    rows = [(k, "a " * r.choice([3, 9, 20, 33, 45, 52])) for k in range(400)]
    out = best_fit_packing.pack(frame(spark, rows).repartition(40), WORDS, capacity=64, slack=1).collect()
    full = fills(out)
    assert Counter(x.doc_id for x in out) == Counter(range(400)) and max(full) <= 64 and full[0] + full[1] > 64
    sequences = defaultdict(list)
    for x in out:
        sequences[x.sequence_id].append((x.offset, x.length))
    for places in map(sorted, sequences.values()):
        assert [a for a, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1]]


def test_best_fit_takes_the_tightest_bin():
    bins, at, fills = best_fit_packing.best_fit(np.array([6, 5, 4, 3, 10, 1]), 10)
    assert fills.tolist() == [10, 10, 9] and bins.tolist()[4] == 0 and len(set(bins.tolist())) == 3
    assert sorted(zip(bins.tolist(), at.tolist()))[0] == (0, 0)


def test_token_files_round_trip(spark):
    rows = [(7 * k % 50, t) for k, t in enumerate(TEXTS)] + [(None, "no id")]
    root = token_files.write(frame(spark, rows).repartition(3), BYTES)
    out = token_files.read(spark, root).orderBy("start").collect()
    start = 0
    for x, (d, t) in zip(out, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), strict=True):
        ids = np.array([*whole(BYTES, t), 0], "<u4")
        assert (x.doc_id, x.start, x.n_tokens, x.ids_crc32) == (d, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files.read(spark, token_files.write(frame(spark, []), BYTES)).count() == 0
    small = token_files.write(frame(spark, rows), BYTES, file_bytes=60)  # files end by their bytes
    assert spark.read.parquet(f"{small}/manifest").count() > 5
    assert [tuple(x) for x in token_files.read(spark, small).orderBy("start").collect()] == [tuple(x) for x in out]


def test_special_tokens_in_a_text_get_their_own_ids():
    for path, pattern, dtype in ((BYTES, tokens.BYTE_LEVEL, "<u2"), (WORDS, tokens.WORD_LEVEL, "<u4")):
        for text in ("a <|endoftext|> b", "<|endoftext|>", "plain<|endoftext|>", "<|EndOfText|> x"):
            got = np.frombuffer(tokens.encoder(path, pattern, dtype)([text])[0], dtype)
            assert got.tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


# --- classifiers --------------------------------------------------------------


def labelled(spark, make):
    r = random.Random(8)
    words = ["river", "boat", "meadow", "town", "hand", "spring", "class", "pass", "idea", "stone"]
    rows, labels = [], []
    for k in range(600):
        y = k % 5 == 0
        text = [r.choice(words) for _ in range(r.randint(5, 60))]
        rows.append((k, make(r, text, y)))
        if k % 3:
            labels.append((k, int(y), int(y)))
    rows += [(1000, None), (1001, ""), (None, "no id"), (1002, "x" * 50_000), (1, rows[1][1])]
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id BIGINT, toxic INT, quality INT")


def right_share(out, labels, column):
    y = {x.doc_id: x[column] for x in labels.collect()}
    kept = [x for x in out if x.held_out and x.doc_id in y]
    assert kept and all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in out if x.doc_id is not None)
    return sum(x.predicted == y[x.doc_id] for x in kept) / len(kept)


def test_toxicity(spark):
    disguises = ["dolt", "D0LT", "dоlt", "ｄｏｌｔ", "doltish", "dolts"]

    def make(r, text, y):
        if y:
            text[r.randrange(len(text))] = r.choice(disguises)
        elif r.random() < 0.2:  # a harmless phrase
            text[0:0] = ["saint", "dolt"]
        return " ".join(text)

    docs, labels = labelled(spark, make)
    out = toxicity.score(docs.withColumn("score", toxicity.F.lit(1)), labels).collect()
    assert len(out) == docs.count() and all(0 <= x.score <= 1 for x in out)
    assert right_share(out, labels, "toxic") > 0.97
    assert next(x for x in out if x.doc_id == 1000).predicted == 0
    none = toxicity.score(docs, labels.where("toxic = 0")).collect()
    assert {x.predicted for x in none} == {0}
    assert toxicity.score(docs.limit(0), labels.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1200, 12_000])
def test_a_rare_toxic_word_counts_in_samples_of_any_size(spark, n):
    words = {9 * k: "dolt scumlord" for k in range(12)}
    rows = [(k, f"plain words {k} {words.get(k, 'dolt') if k % 9 == 0 else ''}", int(k % 9 == 0)) for k in range(n)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "d BIGINT, t STRING, y INT"))
    assert {"dolt", "scumlord"} <= set(lexicon.words)


def test_the_bar_rises_with_the_terms_tested_only():
    assert toxicity.bar(0) == toxicity.bar(100_000) == toxicity.MIN_EVIDENCE
    assert toxicity.MIN_EVIDENCE < toxicity.bar(10**6) < toxicity.bar(10**7) < 42


def plain_hits(lexicon, folded):
    """Every maximal run of letters and digits against every term."""
    found = {}
    for m in re.finditer(r"[^\W_]+", folded):
        weights = [w for t, w in lexicon.words.items() if t == m[0]]
        weights += [w for t, w in lexicon.beginnings.items() if m[0].startswith(t)]
        if weights and max(weights) > 0:
            found[m.start()] = (max(weights), m.end())
    return found


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abc_ .é1", max_size=60), st.dictionaries(st.text("abcé", min_size=1, max_size=4), st.floats(0.1, 9), max_size=8),
       st.dictionaries(st.text("abc", min_size=1, max_size=3), st.floats(0.1, 9), max_size=8))
def test_matches_and_neighbours_equal_a_plain_scan(text, words, beginnings):
    lexicon = toxicity.Lexicon(words, beginnings)
    found = lexicon.hits(text, lexicon.automaton())
    assert found == plain_hits(lexicon, text)
    runs = [m.span() for m in re.finditer(r"[^\W_]+", text)]
    for a, (_, b) in found.items():
        k = runs.index((a, b))
        before = [f"{text[slice(*runs[k - 1])]} {text[a:b]}"] if k else []
        after = [f"{text[a:b]} {text[slice(*runs[k + 1])]}"] if k + 1 < len(runs) else []
        assert lexicon.around(text, a, b) == before + after


def test_a_neighbour_far_away_or_long_is_seen_whole():
    text = "saint" * 20 + " " * 100 + "dolt" + "-" * 100 + "x" * 70
    assert toxicity.Lexicon({"dolt": 1.0}, {}).around(text, 200, 204) == ["saint" * 20 + " dolt", "dolt " + "x" * 70]


def test_repeated_matches_count_beyond_their_weights(spark):
    """A word met once is harmless in most texts and toxic where it comes back."""
    rows = [(k, " ".join(["plain"] * 30 + ["dolt"] * (4 if k % 8 == 0 else k % 4 == 1)), int(k % 8 == 0)) for k in range(800)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "d BIGINT, t STRING, y INT"))
    once, often = (lexicon.score(*lexicon.weigh(" ".join(["plain"] * 30 + ["dolt"] * n), lexicon.automaton())) for n in (1, 4))
    assert once < 0.1 and often > 0.9


def test_the_terms_with_the_most_evidence_stay_at_the_bound(spark, monkeypatch):
    rows = [(k, f"plain words {'dolt dolt' if k % 9 == 0 else ''} {'oaf' if k % 18 == 0 else ''}", int(k % 9 == 0)) for k in range(900)]
    sample = spark.createDataFrame(rows, "d BIGINT, t STRING, y INT")
    assert {"dolt", "oaf"} <= set(toxicity.learn(sample).words)
    monkeypatch.setattr(toxicity, "MAX_TERMS", 1)
    few = toxicity.learn(sample)
    assert {*few.words, *few.beginnings} == {"dolt"}


def dual_solver(x, y, epochs=3000):
    """Hinge loss with a ridge, by projected gradient on the dual with dense matrices."""
    s = np.where(y > 0, 1.0, -1.0)
    q = (x * s[:, None]) @ (x * s[:, None]).T
    alpha, step = np.zeros(len(y)), 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(epochs):
        alpha = np.clip(alpha - step * (q @ alpha - 1), 0, quality_classifier.COST)
    return (x * s[:, None]).T @ alpha


def test_support_vectors_equal_a_dense_solver(monkeypatch):
    monkeypatch.setattr(quality_classifier, "BITS", 6)
    monkeypatch.setattr(quality_classifier, "EPOCHS", 400)
    r = np.random.default_rng(4)
    y = (np.arange(60) % 3 == 0).astype(int)
    rows = [np.sort(r.choice(64, size=r.integers(1, 20), replace=False)).astype(np.int32) for _ in y]
    pos, neg = np.full(64, quality_classifier.SMOOTHING), np.full(64, quality_classifier.SMOOTHING)
    for row, label in zip(rows, y):
        (pos if label else neg)[row] += 1
    ratio = np.log(pos / pos.sum()) - np.log(neg / neg.sum())
    dense = np.zeros((len(y), 64))
    for k, row in enumerate(rows):
        dense[k, row] = ratio[row] / np.sqrt(len(row))
    got = quality_classifier.fit(rows, y)
    want = dual_solver(dense, y) * ratio
    np.testing.assert_allclose(got, want, atol=2e-2 * np.abs(want).max())


def test_ties_of_labels_and_clashing_columns(spark):
    """Equal texts with both labels, and columns named like the operators' own, change nothing and fail nowhere."""
    rows = [(k, "alpha beta gamma " + ("dolt" if k % 4 == 0 else "kind")) for k in range(200)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(k, int(k % 8 == 0), int(k % 8 == 0)) for k in range(200)],
                                   "doc_id BIGINT, toxic INT, quality INT")
    named = docs
    for extra in ("d", "t", "y", "term", "score", "total", "words", "held_out", "block", "toxic", "quality"):
        named = named.withColumn(extra, toxicity.F.lit(3))
    for module in (toxicity, quality_classifier):
        plain = {tuple(x) for x in module.score(docs, labels).collect()}
        assert {tuple(x) for x in module.score(named, labels).collect()} == plain
        assert len({round(x[2], 9) for x in plain}) <= 2  # equal texts, equal scores


def test_folding():
    assert toxicity.fold("1D10T") == "idiot" and toxicity.fold("Ѕtυрid") == "stupid" and toxicity.fold("in 1984") == "in 1984"


def test_quality_classifier(spark):
    def make(r, text, y):
        return " ".join(text) if y else " ".join(f"{w}###" for w in text)

    docs, labels = labelled(spark, make)
    out = quality_classifier.score(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= x.score <= 1 for x in out)
    assert right_share(out, labels, "quality") > 0.97
    assert {x.predicted for x in quality_classifier.score(docs, labels.where("quality = 1")).collect()} == {1}
    assert quality_classifier.score(docs.limit(0), labels.limit(0)).count() == 0


# --- pages --------------------------------------------------------------------


def test_reading_broken_markup():
    nodes = read("<p>a &amp; b<br>c<p>d<b> e</p><script>x<p></script><ul><li>f<li><a>g</a></ul>h<!-- <p>i --><td>j &lt")
    assert [n.text for n in nodes if n.tag == "#text"] == ["a & b c", "d e", "f", "g", "h", "j <"]
    assert [nodes[n.parent].tag for n in nodes if n.text in ("f", "g")] == ["li", "li"]
    assert len(read("<div>" * 5000 + "deep" + "</div>" * 5000)) == 5002
    for page in ("<a " * 350_000, '<a ">" ' * 150_000, "<div>" * 100_000 + "</nav>" * 100_000, "<svg>" * 200_000,
                 "<li><ul>" + "<form>" * 80_000 + "<li></li>" * 60_000, "<script>" + "</script " * 120_000):
        began = time.perf_counter()
        read(page)  # a megabyte each
        assert time.perf_counter() - began < 15


def test_marginals_equal_enumeration():
    """Sum-product against summing over all labelings of a small page."""
    from itertools import product

    model = html_extraction.learn()
    nodes = read("<div class=menu><a href=x>Home</a></div><main><p>The boats came in, at noon.</p>x</main>")
    n, weight = len(nodes), [0.0] * len(nodes)
    ties = [model.ties[html_extraction._kind(node)] for node in nodes]
    total = 0.0
    for labels in product(html_extraction.LABELS, repeat=n):
        p = model.prior[labels[0]]
        for k in range(1, n):
            p *= ties[k][labels[nodes[k].parent]][labels[k]]
            if nodes[k].text and labels[k] == html_extraction.FRAME:
                p *= 1e-6
            for o in html_extraction.observations(nodes[k], nodes[nodes[k].parent]):
                p *= (model.text if nodes[k].text else model.factors).get(o, [1, 1, 1])[labels[k]] if not (
                    nodes[k].text and labels[k] == html_extraction.FRAME) else 1
        total += p
        for k, y in enumerate(labels):
            weight[k] += p * (y == html_extraction.CONTENT)
    assert model.marginals(nodes) == pytest.approx([w / total for w in weight], abs=1e-4)


def test_extraction(spark):
    pages = [(k, f"u{k}", p.replace("data-label", "data-other")) for k, p in enumerate(html_extraction.LABELLED)]
    rows = spark.createDataFrame([*pages, (90, "u", None), (91, None, ""), (None, "u", "<p>"), pages[1]],
                                 "page_id BIGINT, url STRING, html STRING")
    out = html_extraction.extract(rows).collect()
    assert len(out) == len(pages) + 4
    texts = {x.page_id: x.text for x in out}
    for k, p in enumerate(html_extraction.LABELLED):
        nodes, labels = html_extraction.labelled(p, by_markup=False)
        want = [n.text for n, y in zip(nodes, labels) if n.text and y == html_extraction.CONTENT]
        got = texts[k].split("\n")
        assert len(set(want) ^ set(got)) <= 1, (k, want, got)
    assert texts[90] == texts[91] == "" and all(x.n_chars == len(x.text) for x in out)
    assert html_extraction.extract(rows.limit(0)).count() == 0

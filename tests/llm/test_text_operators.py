"""Quality rules, line dedup, near duplicates and decontamination against brute force."""

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from odolake.llm import decontamination, line_dedup, ngram_join, quality_rules
from odolake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "no id"), (None, None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING")


def clashing(spark):
    """Rows whose other columns are called what the operators call theirs."""
    rows = [(1, "a b", 1, "x", True, 2), (2, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id BIGINT, text STRING, n_words INT, sources STRING, kept BOOLEAN, l_key INT")


# --- quality rules ------------------------------------------------------------


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark):
    r = random.Random(1)
    texts = [t for _, t in EDGE] + ["x" * 100_000, "é ñ " * 3000, "the cat\n" * 60, " a b c d e f g h " * 2]
    for _ in range(60):
        words = [r.choice(["a", "bb", "#", "C|D", "é", "\n", " x"]) for _ in range(r.randint(0, 60))]
        texts.append(r.choice([" ", "\t", "  "]).join(words))
    rows = list(enumerate(texts))
    got = quality_rules.assess(frame(spark, rows), quality_rules.RULES).collect()
    assert len(got) == len(rows)
    for x in got:
        want = counts(dict(rows)[x.doc_id])
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want, rows[x.doc_id]
        assert x.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (x.base_failed and x.kept)


def test_quality_verdict_does_not_depend_on_the_order(spark):
    good = "In spring the river rises and all the boats of the town are taken up to the meadow by hand as they were long ago."
    bad = ["WORD " + "LOUD SHOUTED TEXT " * 3 + " ".join(f"UP{k}" for k in range(20)), "x### y$$$ z%%% " * 3 + good, "ab " * 30]
    rows = frame(spark, list(enumerate([good, *bad])))
    for rules in (quality_rules.RULES, quality_rules.RULES[::-1]):
        assert {x.doc_id for x in quality_rules.assess(rows, rules).where("kept").collect()} == {0}
    order = quality_rules.cascade_order(rows)
    assert sorted(r.name for r in order) == sorted(r.name for r in quality_rules.RULES)
    assert quality_rules.keep_good(rows).columns == ["doc_id", "text"]
    every = (*quality_rules.BASE_RULES, *quality_rules.RULES)
    for rules in (every, every[::-1], None):
        assert [x.doc_id for x in quality_rules.keep_good(rows, rules=rules).collect()] == [0]


def test_order_goes_by_rejections_per_cost():
    a, b, c = quality_rules.RULES[:3]
    seen = [((True, False, True), 50), ((False, True, False), 20), ((False, False, True), 10), ((False, False, False), 900)]
    order = lambda *cost: quality_rules.ordered([a, b, c], cost, seen)
    assert order(1, 1, 100) == [a, b, c]
    assert order(100, 1, 1) == [c, b, a]  # what is left for the first rejects nothing any more
    assert order(1, 0.1, 9) == [b, a, c]
    assert order(1, 1.1, 0.9) == order(1, 0.9, 1.1)  # no clear difference: as listed


def test_costs_are_those_of_the_rules_own_work(spark):
    """A rule that does far more comes after one that does little, whatever the place in the list, run after run."""
    texts = [" ".join(f"w{(k * j) % 50}" for j in range(400)) for k in range(400)]
    rows = frame(spark, list(enumerate(texts)))
    cheap = quality_rules.Rule("cheap", lambda c: c("n_words") > 100)
    costly = quality_rules.Rule("costly", lambda c: (c("n_repeat_words") >= 0) & (c("n_words") > 100))
    for rules in ([cheap, costly], [costly, cheap], [costly, cheap]):
        assert [r.name for r in quality_rules.cascade_order(rows, rules)] == ["cheap", "costly"]


def test_quality_edges(spark):
    assert quality_rules.assess(frame(spark, [])).count() == 0
    assert quality_rules.assess(frame(spark, EDGE)).count() == len(EDGE)
    out = quality_rules.assess(clashing(spark), quality_rules.RULES)
    assert len(set(out.columns)) == len(out.columns) and {r.n_words for r in out.collect()} == {0, 2}
    assert quality_rules.keep_good(clashing(spark)).columns == clashing(spark).columns


# --- line dedup ---------------------------------------------------------------


def expected_lines(rows, least):
    """Lines inside a run of ``least`` words or more that stands earlier, by trying every run."""
    order = sorted({(d, t) for d, t in rows}, key=lambda x: (x[0] is not None, x[0] or 0))
    docs = []
    for _, t in order:
        raw = (t or "").split("\n")
        docs.append([(k, x.strip(" \t\n\x0b\f\r")) for k, x in enumerate(raw) if WORD.search(x)])
    first, out = {}, {}
    for n, lines in enumerate(docs):
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = tuple(x for _, x in lines[a:b + 1])
                if sum(len(WORD.findall(x)) for x in run) >= least:
                    first.setdefault(run, (n, a))
    for n, lines in enumerate(docs):
        gone = set()
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = tuple(x for _, x in lines[a:b + 1])
                if sum(len(WORD.findall(x)) for x in run) >= least and first[run] < (n, a):
                    gone.update(range(lines[a][0], lines[b][0] + 1))
        text = order[n][1]
        raw = (text or "").split("\n")
        out[order[n]] = text if not gone else "\n".join(x for k, x in enumerate(raw) if k not in gone)
    return out


def test_lines_match_through_their_fingerprint(spark, monkeypatch):
    """Equal lines on both sides are no match where the selected line itself differs."""
    side = ["left " * 20, "right " * 20]
    rows = [(k, "\n".join([side[0].strip(), " ".join(f"own{k}{j}" for j in range(20)), side[1].strip()])) for k in range(12)]
    out = line_dedup.dedup_lines(frame(spark, rows)).collect()
    assert {x.n_removed for x in out} == {0}
    lines = line_dedup.line_table(frame(spark, rows), "doc_id", "text")
    found = line_dedup.extended(line_dedup.windows(lines, 50), lines)  # without the join on fingerprints
    same_sides = found.groupBy("left", "right").count().where("count > 1").count()
    assert same_sides > 0 and found.groupBy("finger", "left", "right").count().where("count > 1").count() == 0


def test_line_dedup_equals_brute_force(spark):
    r = random.Random(4)
    rows = list(EDGE)
    for d in range(10, 70):
        lines = [r.choice(["a b c", "d e", " d e ", "f", "g h i j k", "", "  ", "l m n o p q r"]) for _ in range(r.randint(0, 12))]
        rows.append((d, "\n".join(lines)))
    want = expected_lines(rows, 8)
    got = line_dedup.dedup_lines(frame(spark, rows), min_words=8).collect()
    assert len(got) == len(rows)
    for (d, t) in rows:
        assert want[d, t] in [x.text for x in got if x.doc_id == d]
    assert sorted(map(str, (x.text for x in got))) == sorted(str(want[k]) for k in rows)


def test_line_dedup_edges(spark):
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0
    out = line_dedup.dedup_lines(clashing(spark))
    assert len(set(out.columns)) == len(out.columns) and out.count() == 2
    long = "\n".join(f"line {k} of a long text" for k in range(4000))
    rows = line_dedup.dedup_lines(frame(spark, [(1, long), (2, "own\n" + long)])).orderBy("doc_id").collect()
    assert (rows[0].text, rows[1].text, rows[1].sources, rows[1].n_removed) == (long, "own", [1], 4000)
    kept = line_dedup.without_repeats(frame(spark, [(1, long), (2, long), (3, None), (4, "")]))
    assert sorted(x.doc_id for x in kept.collect()) == [1, 3, 4]


def test_hot_line_links_to_one_place(spark):
    hot = " ".join(f"w{k}" for k in range(60))
    docs = frame(spark, [(k, f"start {k}\n{hot}\nend {k}") for k in range(300)])
    spans = line_dedup.repeated_spans(docs)
    assert spans.count() <= 3 * 299 and {x.source for x in spans.collect()} == {0}


# --- near duplicates ----------------------------------------------------------


def grams(text):
    words = [w.lower() for w in WORD.findall(text or "")]
    return set(zip(*[words[k:] for k in range(5)])) if len(words) >= 5 else ({tuple(words)} if words else set())


def expected_classes(rows):
    texts = {}
    for d, t in rows:
        texts.setdefault(t, []).append(d)
    keys, links = list(texts), Counter()
    sets, group = [grams(t) for t in texts], list(range(len(texts)))
    for a in range(len(keys)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    out = {}
    for k, t in enumerate(keys):
        ids = [d for j, other in enumerate(keys) if group[j] == group[k] for d in texts[other] if d is not None]
        out[t] = (min(ids, default=None), links[k], len(texts[t]))
    return out


def near_rows(n=60):
    r = random.Random(9)
    vocabulary = [f"v{k}" for k in range(400)]
    rows = list(EDGE) + [(6, "A b"), (7, "a  B")]
    for base in range(4):
        words = [r.choice(vocabulary) for _ in range(80 + 40 * base)]
        for k in range(n):
            copy = list(words)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            rows.append((1000 * (base + 1) + k, " ".join(copy)))
    return rows + [(9000 + k, rows[20][1]) for k in range(30)]


@pytest.mark.parametrize("block", [384, 16])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)  # small blocks deal large buckets out
    rows = near_rows()
    want = expected_classes(rows)
    got = ngram_join.near_duplicates(frame(spark, rows)).collect()
    by_id = {x.doc_id: x for x in got if x.doc_id is not None}
    assert len(got) == len(rows)
    for d, t in rows:
        if d is not None:
            assert (by_id[d].class_id, by_id[d].n_links, by_id[d].n_copies) == want[t], (d, t)


def test_one_document_of_each_group_stays(spark):
    rows = near_rows(20)
    want = expected_classes(rows)
    kept = ngram_join.one_of_each(frame(spark, rows).selectExpr("*", "1 AS n_key", "2 AS class_id"))
    assert kept.columns == ["doc_id", "text", "n_key", "class_id"]
    ids = [x.doc_id for x in kept.collect()]
    assert len(ids) == len(set(ids)) and {d for d in ids if d is not None} == {c for c, *_ in want.values() if c is not None}
    assert ngram_join.one_of_each(frame(spark, [])).count() == 0
    assert ngram_join.near_duplicates(frame(spark, [(None, None), (None, "a")])).count() == 2


def test_bands_reach_the_recall():
    for similarity in (0.5, 0.7, 0.8, 0.9):
        bands, rows = ngram_join.choose_bands(similarity, 0.99, 200)
        assert 1 - (1 - similarity**rows) ** bands >= 0.99 and bands * rows <= 200


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (7, 7), (200, 100), (40, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u BIGINT, v BIGINT")).collect()}
    assert found == {k: 0 for k in range(41)} | {100: 100, 101: 100, 200: 100}


def test_components_that_are_not_settled_raise(spark):
    path = spark.createDataFrame([(k, k + 1) for k in range(64)], "u BIGINT, v BIGINT")
    with pytest.raises(RuntimeError, match="not settled"):
        components(path, rounds=2)
    assert {(x.node, x.root) for x in components(path).collect()} == {(k, 0) for k in range(65)}


# --- decontamination ----------------------------------------------------------


def edits_of_best_stretch(item, text):
    row = [0] * (len(text) + 1)
    for n, c in enumerate(item, 1):
        fresh = [n]
        for k, d in enumerate(text, 1):
            fresh.append(min(row[k - 1] + (c != d), row[k] + 1, fresh[-1] + 1))
        row = fresh
    return min(row)


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_decontamination_finds_every_item_within_its_edits(data):
    r = random.Random(data.draw(st.integers(0, 10**6)))
    items = ["".join(r.choice("abcd ") for _ in range(r.randint(1, 90))) for _ in range(4)]
    lengths = {}
    for k, t in enumerate(items):
        if size := len(decontamination.normal(t)):
            lengths.setdefault(decontamination.gram_length(size, 8, 0.1), []).append((k, t))
    indexes = [decontamination.Index.build(rows, q, 0.1) for q, rows in lengths.items()]
    texts = []
    for t in items:
        letters = list(t)
        for _ in range(r.randint(0, len(t) // 10)):
            letters[r.randrange(len(letters))] = r.choice("abcdxyz")
        texts.append("".join(r.choice("efgh ") for _ in range(r.randint(0, 40))) + " " + "".join(letters))
    got = {(d, i): e for d, i, _, _, e in decontamination._looked_at(texts, indexes)}
    for d, text in enumerate(texts):
        for k, item in enumerate(items):
            if t := decontamination.normal(item):
                best = edits_of_best_stretch(t, decontamination.normal(text))
                assert got.get((d, k)) == (best if best <= len(t) // 10 else None)


def test_items_of_ten_to_forty_characters_keep_all_their_edits(spark):
    items = ["tenletters", "a dozen ones", "twenty letters at it", "some thirty letters are in this one",
             "an item of well over forty characters, no less"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING")
    spoiled = []
    for t in items:
        k = len(t) // 10
        places = [(2 * j + 1) * len(t) // (2 * k) for j in range(k)]  # spread, so as few q-grams as can be stay whole
        letters = list(t)
        for p in places:
            letters[p] = "#"
        spoiled.append("".join(letters))
        letters[0] = "#"
        spoiled.append("".join(letters))  # one edit too many
    docs = frame(spark, [(d, f"before it {t} behind it") for d, t in enumerate(spoiled)])
    out = {(x.doc_id, x.item_id, x.edits) for x in decontamination.contained(docs, bench).collect()}
    assert out == {(2 * k, k, len(t) // 10) for k, t in enumerate(items)}


def test_decontamination(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "CHUNK_CHARS", 300)
    item = "The quick brown fox jumps over the lazy dog, while the cat looks on from the warm wall."
    docs = frame(spark, [*EDGE, (10, f"Before. {item.upper()} After."), (11, "Before " + item.replace("lazy", "lady")),
                         (12, item[:40]), (13, "z " * 50_000 + item), (13, item)])
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "tiny")], "item_id BIGINT, text STRING")
    found = sorted((x.doc_id, x.item_id, x.edits) for x in decontamination.contained(docs, bench).collect())
    assert found == [(10, 1, 0), (11, 1, 1), (13, 1, 0), (13, 1, 0)]
    kept = decontamination.decontaminated(docs.selectExpr("*", "doc_id AS item_id", "1 AS start"), bench)
    assert kept.columns == ["doc_id", "text", "item_id", "start"] and kept.count() == docs.count() - 4
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 20)  # the benchmark in several blocks
    assert sorted((x.doc_id, x.item_id, x.edits) for x in decontamination.contained(docs, bench).collect()) == found
    assert decontamination.contained(docs, bench.limit(0)).count() == 0
    assert decontamination.contained(frame(spark, []), bench).count() == 0

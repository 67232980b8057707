"""The pipeline on a small corpus, stage by stage, and the registered queries."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from odolake.llm.decontamination import normal
from test_text_operators import WORD, counts, edits_of_best_stretch, expected_classes, expected_lines


def sentence(k, n=60):
    return " ".join(f"{w}{(k * 7 + j) % 97}" for j, w in enumerate(["river", "boat", "meadow", "town", "hand"] * (n // 5)))


def test_pipeline(spark, tmp_path):
    passage = "The shared passage stands here: " + " ".join(f"word{k}" for k in range(60))
    item = "Which of the two rivers in the county is the longer one, and where does it meet the sea at last?"
    own = [f"{sentence(k)} {'abcdefghij'[k]} {sentence(k + 40)}" for k in range(8)]
    docs = [
        (0, own[0] + "\n" + passage), (1, own[1] + "\n" + passage), (2, own[2]), (3, own[2]),
        (4, own[2].replace("river14", "brook")), (5, "too short"), (6, "x### y$$$ z%%% " * 20), (7, own[3] + " " + item),
        (8, own[4]), (9, None), (10, own[5]), (11, own[6]),
    ]
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in docs],
                          "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {0: docs[0][1], 1: own[1], 2: own[2], 8: own[4], 10: own[5], 11: own[6]}
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for d, text in kept.items():
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want[d, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((x.doc_id, x.length, x.ids_crc32) for x in out) == want
    sequences = {}
    for x in out:
        sequences.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for pieces in sequences.values():  # gapless from 0, and no sequence is too long
        ends = [0]
        for offset, length in sorted(pieces):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
    assert len(sequences) == -(-sum(x.length for x in out) // 2048)


def good(text):
    """The quality rules in plain Python."""
    n, chars, symbols, repeated_lines, repeated_words = counts(text)
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    if n < 20 or 100 * repeated_words > 30 * n or 10 * symbols > 3 * n or chars > 15 * n or chars < 2 * n:
        return False
    if 10 * repeated_lines > 4 * len(lines) or 10 * sum(x == y for x, y in zip(words, words[1:])) > 4 * n:
        return False
    return 2 * sum(c.isupper() for c in text) <= sum(c.isalpha() for c in text)


def plain_pipeline(rows, items):
    """Pieces as (doc_id, piece, start, length, checksum), by the brute-force version of each stage."""
    rows = [x for x in rows if good(x[1])]
    cut = expected_lines(rows, 50)
    rows = [(d, cut[d, t]) for d, t in rows if WORD.search(cut[d, t])]  # one that lost all its words goes
    classes = expected_classes(rows)
    rows = sorted({(d, t) for d, t in rows if d == classes[t][0]})
    least = {normal(t): len(normal(t)) // 10 for t in items if normal(t or "")}
    rows = [(d, t) for d, t in rows
            if all(edits_of_best_stretch(item, normal(t)) > edits for item, edits in least.items())]
    encoder, out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), Counter()
    for d, t in rows:
        ids = np.array([*encoder.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for n, start in enumerate(range(0, len(ids), 2048)):
            piece = ids[start:start + 2048]
            out[d, n, start, len(piece), zlib.crc32(piece.tobytes())] += 1
    return out


def corpus(seed):
    """Documents with every kind of fault, some of them with several."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice(["ka", "lo", "mi", "ren", "tu", "sha", "po"]) for _ in range(r.randint(2, 4))) for _ in range(500)]

    def line(n):
        return " ".join(r.choice(vocabulary) for _ in range(n))

    items = [line(12), line(16), None, ""]
    shared, rows = [line(55) for _ in range(3)], [(900, None), (901, ""), (902, " \n "), (903, "WORDS IN CAPITALS " * 9)]
    for d in range(34):
        lines = [line(r.randint(12, 20)) for _ in range(r.randint(2, 5))]
        if d % 4 == 0:
            lines.insert(r.randrange(3), shared[d % 3])  # once cut out, some of them become near copies or short
        if d % 7 == 0:
            letters = list(items[d % 2])
            letters[r.randrange(len(letters))] = "#"
            lines[0] += " " + "".join(letters)
        if d % 9 == 1:
            lines = [line(r.randint(1, 9))]
        rows.append((d, "\n".join(lines)))
        if d % 5 == 0:  # near copies, with or without a shared passage
            words = lines[-1].split()
            words[min(3, len(words) - 1)] = r.choice(vocabulary)
            rows.append((100 + d, "\n".join([*lines[:-1], " ".join(words)] + [shared[0]] * (d % 2))))
        if d % 6 == 0:
            rows += [(200 + d, rows[-1][1]), rows[-1]]  # an exact copy, and a repeated row
    rows.append((300, "\n".join(line(30) for _ in range(60))))  # longer than a sequence
    r.shuffle(rows)
    return rows, items


def run_on(spark, folder, rows, items):
    made = [(3, d, t, None, "s", len(t or "")) for d, t in rows]
    spark.createDataFrame(made, "class_id INT, doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    return corpus_pipeline.run(spark, str(folder)).collect()


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows, items = corpus(3)
    want = plain_pipeline(rows, items)
    kept = {d for d, *_ in want}
    assert 10 < len(kept) < len({d for d, _ in rows}) - 10 and sum(n for _, n, *_ in want) > 0
    out = run_on(spark, tmp_path, rows, items)
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in out) == want
    sequences = {}
    for x in out:
        sequences.setdefault(x.sequence_id, []).append((x.offset, x.length))
    fill = []
    for pieces in sequences.values():
        offsets = sorted(pieces)
        assert [o for o, _ in offsets] == [sum(n for _, n in offsets[:k]) for k in range(len(offsets))]
        fill.append(sum(n for _, n in offsets))
    assert max(fill) <= 2048 and sum(sorted(fill)[:2]) > 2048  # no two would fit into one


def test_pipeline_of_empty_tables(spark, tmp_path):
    assert run_on(spark, tmp_path, [], []) == []


def test_stages_and_queries():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "ngram_join", "decontamination", "best_fit_packing"]
    names = contract.queries()
    assert "pipeline" in names and all(sum(q.startswith(f"op{n}_") for q in names) == 1 for n in range(1, 14))

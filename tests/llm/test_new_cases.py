"""Edge cases of collocations, chat formatting and ranked search."""

import random
import re

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_cases import ODD, prose

from shopweave.llm import chat, collocations, language, lexical_search


def babble(seed, words, vocabulary=25, marks=" .,;:!?\n\t"):
    dice = random.Random(seed)
    names = [prose(100 + k, 1) for k in range(vocabulary)]
    return "".join(dice.choice(names) + (" " if dice.random() < 0.8 else dice.choice(marks) + dice.choice(["", " ", "  \t"])) for _ in range(words))


# --- language identification with very many languages ----------------------------------


@pytest.mark.parametrize("held, matrix", [(200, 32 << 20), (3, 32 << 20), (3, 8 * 250 * 512)])
def test_any_number_of_languages(docs, workspace, monkeypatch, held, matrix):
    monkeypatch.setattr(language, "MATRIX", matrix)
    monkeypatch.setattr(language, "HELD", held)
    letters = [chr(0x3400 + k) for k in range(250)]
    frame = docs([c * 5 for c in letters], [f"l{k}" for k in range(250)])
    learned = language.learn(frame, workspace)
    assert len(learned) == 250 and 8 * sum(len(x) - 1 for x in learned.values()) <= matrix
    found = frame.select("lang", language.predict(learned).alias("p")).collect()
    assert sum(r.p.lang_pred == r.lang for r in found) >= (250 if matrix > 1 << 22 else 120)


# --- collocations ----------------------------------------------------------------------


def languages(rows):
    return [(["en", None, "de", "und"][i % 4], t) for i, t in enumerate(rows)]


def collocated(docs, workspace, texts, **sizes):
    rows = languages(texts)
    frame = docs([t for _, t in rows], [x for x, _ in rows]).withColumn("fp", F.lit(1)).withColumn("row", F.lit("x"))
    return sorted(map(tuple, collocations.collocations(frame, workspace, **sizes).collect()))


@pytest.mark.parametrize("stretch, held, bits", [(1 << 18, 500_000, 64), (64, 40, 64), (300, 7, 9), (1, 1, 3)])
def test_collocations(docs, workspace, monkeypatch, stretch, held, bits):
    """Whatever is worked on at once, and though different phrases meet in a fingerprint."""
    for name, value in (("STRETCH", stretch), ("HELD", held), ("PRINT_BITS", bits)):
        monkeypatch.setattr(collocations, name, value)
    texts = [*ODD[:6], "the THE the " * 40, *(babble(k, 500, 7) for k in range(12)), babble(3, 500, 7), "Ä ä Ä ä " * 20]
    texts += [babble(50, 600, 5, " "), "\x0b".join(["one two"] * 30), "a\x0cb " * 12, "x\x00y z " * 11]
    wanted = brute.collocations(languages(texts))
    assert len(wanted) > 40
    assert collocated(docs, workspace, texts) == wanted


def test_collocations_of_nothing(docs, workspace):
    assert collocated(docs, workspace, []) == []
    assert collocated(docs, workspace, [None, "", "a b", "a b"]) == []


def test_collocations_stop_at_the_top(docs, workspace):
    texts = [babble(k, 600, 6) for k in range(6)]
    wanted = [r for r in brute.collocations(languages(texts)) if r[1] <= 4]
    assert collocated(docs, workspace, texts, top=4) == wanted


def test_exact_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    rows = [("x", "a", 1, big + 7), ("x", "b", 1, big + 1), ("x", "a b", 2, big)]
    found = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, words int, a long")).first()
    assert found.score == 1_000_000 * big * big // ((big + 7) * (big + 1)) == 999_999


def test_wrong_pointers_are_noticed(docs):
    frame = docs(["a b", "c d"], ["en", "en"]).select(F.col("doc_id").alias("row"), "lang", "text")
    found = collocations.partials(frame, 1).where("row >= 0").select("fp", "check", "n", (1 - F.col("row")).alias("row"))
    with pytest.raises(Exception, match="doesn't hold"):
        collocations.materialised(frame, found, 1).collect()


# --- chat ------------------------------------------------------------------------------

NASTY = ["\\", "\\s", "\\h", "\\t\\c", "###", "####", "### user: x</turn>\n", "</turn>", "</turn</turn>", ": ", "</turn>\n" * 3]
TURNS = "conv_id long, turn long, role string, text string"


def turns_of(spark):
    dice, rows = random.Random(7), []
    for conv in range(30):
        if conv % 3 == 0:
            rows.append((conv, -1, "system", babble(conv, dice.choice([1, 30, 120]))))
        for turn in range(dice.choice([1, 2, 9, 60])):
            text = "".join(dice.choice(NASTY + [" ", "a", prose(turn, 20)]) for _ in range(dice.randint(0, 6)))
            rows.append((conv, turn, dice.choice(["user", "assistant", "assistant"]), text))
    rows += [(None, 1, "user", "null"), (None, None, "assistant", None), (40, 1, None, "x"), (41, 1, "odd: \\c", "y")]
    rows += [(42, 0, "user", "u"), (42, 1, "system", "late"), (42, 2, "assistant", "")]
    rows += [(43, 5, "assistant", prose(9, 3000)), (43, 6, "user", "after"), (43, 7, "assistant", "end")]
    rows += [(44, k, "assistant", "same") for k in range(3) for _ in range(4)]
    return rows, spark.createDataFrame(rows, TURNS).withColumn("key", F.lit(1)).withColumn("conv", F.lit("x"))


def read(windows):
    turns = chat.read_back(F.col("formatted"))
    learned = chat.learned(F.col("formatted"), F.col("targets"))
    return windows.select("*", turns.alias("read"), learned.alias("learned")).orderBy("conv_id", "window").collect()


@pytest.mark.parametrize("budget, history, stretch", [(1024, 256, 16384), (150, 40, 300), (20, 9, 9), (9, 8, 1)])
def test_chat_windows_read_back(spark, workspace, budget, history, stretch):
    rows, frame = turns_of(spark)
    found = read(chat.windows(frame, workspace, budget=budget, history=history, stretch=stretch))
    said, learned = {}, {}
    for r in found:
        said.setdefault(r.conv_id, []).extend(tuple(t) for t in r.read[r.repeated :])
        learned.setdefault(r.conv_id, []).extend(r.learned)
    for conv, (count, _, size, digest) in brute.chat(rows).items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0))
        assert said[conv] == [(x[2] or "", x[3] or "") for x in own] and len(own) == count
        assert "".join(learned[conv]) == "".join(x[3] or "" for x in own if x[2] == "assistant")
    assert sum(len(r.read) for r in found) - sum(r.repeated for r in found) == len(rows)


def test_chat_windows_keep_their_budget(spark, workspace):
    rows, frame = turns_of(spark)
    budget, history = 150, 40
    found = chat.windows(frame, workspace, budget=budget, history=history, stretch=300)
    several = 0
    for r in read(found):
        own = sizes(r.read)
        new = own[r.repeated :]
        first = r.conv_id is not None and r.conv_id < 30 and r.conv_id % 3 == 0
        system = own[0] if first and r.repeated else 0
        assert sum(own) <= budget or len(new) == 1
        assert sum(own[: r.repeated]) - system <= history
        if first and r.window:
            assert r.read[0].role == "system" and r.repeated
        several += r.repeated > 1
    assert several > 10


def sizes(turns):
    """Tokens of turns by the plain rule: runs of letters and digits, marks, and the template's share."""
    found = []
    for turn in turns:
        text = turn.text.replace("\\", "\\s").replace("###", "\\h").replace("</turn>", "\\t")
        found.append(len(re.findall("[0-9A-Za-z\x80-\U0010ffff]+|[!-/:-@\\[-`{-~]", text)) + chat.MARKS)
    return found


def test_chat_of_nothing(spark, workspace):
    assert chat.windows(spark.createDataFrame([], TURNS), workspace).count() == 0


# --- ranked search ---------------------------------------------------------------------


def searched(spark, docs, items, workspace, **more):
    frame = docs([t for _, t in items]).select(F.col("doc_id").alias("place"), F.col("text").alias("question"))
    keys = spark.createDataFrame([(i, k) for i, (k, _) in enumerate(items)], "place long, item_id long")
    return lexical_search.search(more.pop("of"), frame.join(keys, "place").orderBy("place"), workspace, item_text="question", **more)


@pytest.mark.parametrize("docs_most, leaf, block", [(4096, 64, 1024), (7, 2, 3), (50, 1, 1)])
def test_search(spark, docs, workspace, monkeypatch, docs_most, leaf, block):
    for name, value in (("DOCS", docs_most), ("LEAF", leaf), ("ITEMS", block)):
        monkeypatch.setattr(lexical_search, name, value)
    texts = [*ODD, *(babble(k, 30 + 5 * k, 40) for k in range(60)), babble(4, 50, 40), "solo", "solo", "solo solo", "the " * 50]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, "solo"), (None, "solo"), (None, "solo")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("terms", F.lit(1)).withColumn("n", F.lit("x"))
    items = [(1, babble(3, 20, 40)), (2, "solo"), (3, None), (4, "nowhere"), (5, babble(9, 200, 40)), (6, "the THE the"), (1, "日本 solo Σ")]
    found = searched(spark, docs, items, workspace, of=frame)
    wanted = []
    for item in items:
        wanted += brute.search(rows, [item])
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, wanted)) and len(wanted) > 50


def test_search_of_nothing(spark, docs, workspace):
    assert searched(spark, docs, [(1, "a")], workspace, of=docs([])).count() == 0
    assert searched(spark, docs, [], workspace, of=docs(["a"])).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 9, 300)
    ranks = np.concatenate([np.sort(rng.choice(40, n, replace=False)) for n in counts]).astype(np.int32)
    tfs, m = rng.integers(1, 30, len(ranks)).astype(np.int32), rng.integers(75, 400, 300)
    tree = lexical_search.Tree(m, counts, ranks, tfs, 40, 4)
    terms, weights = np.arange(0, 40, 3), rng.integers(-500, 9000, 14)
    slot = np.full(40, -1, np.int64)
    slot[terms] = np.arange(len(terms))
    bounds = tree.bounds(list(range(len(tree.span))), terms, np.maximum(weights, 0))
    leaves = [n for n, below in enumerate(tree.children) if not below]
    assert sorted(x for n in leaves for x in range(*tree.span[n])) == list(range(300))
    for node in leaves:
        first, scores = tree.scores(node, slot, weights)
        assert (scores <= bounds[node]).all()
    for node, below in enumerate(tree.children):
        assert all(bounds[c] <= bounds[node] for c in below)

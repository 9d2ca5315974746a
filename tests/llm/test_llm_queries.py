"""Registered queries over the driver's smallest tables, against plain versions of their contracts."""

import hashlib
import math
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from engines import connect, duck_rows, spark_rows

import __spark_entry__ as entry_points
from shopweave.llm.oracles import ORACLES
from shopweave.llm.queries import QUERIES, TOKENIZER


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    def run(name):
        return QUERIES[name](spark, sf_dir).collect()

    return run


def test_every_query_is_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())


def test_embeddings(rows, sf_dir):
    vectors = pq.read_table(f"{sf_dir}/embeddings.parquet").to_pylist()
    wanted = brute.embeddings([(r["vec_id"], r["embedding"]) for r in vectors])
    found = rows("op1_embedding_near_dedup")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == sorted(wanted)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_bpe(rows, texts):
    plain = Tokenizer.from_file(TOKENIZER)
    found = {r.doc_id: r for r in rows("op2_bpe_encoding")}
    assert len(found) == len(texts)
    for doc, text in texts:
        ids = plain.encode(text or "", add_special_tokens=False).ids
        assert found[doc].n_tokens == len(ids)
        assert found[doc].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = plain.decode(ids, skip_special_tokens=False)
        assert found[doc].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_language(rows, sf_dir):
    langs = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()}
    found = rows("op3_language_id")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_quality(rows, texts):
    found = {r.doc_id: r for r in rows("op4_quality_rules")}
    for doc, text in texts:
        r = found[doc]
        base = r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed
        assert base == brute.quality(text)
        assert (r.covered_5, r.covered_8) == (brute.covered(text, 5), brute.covered(text, 8))
        assert not (r.base_failed and r.kept)


def test_simhash(rows, texts):
    found = sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows("op5_simhash_near_dedup"))
    assert found == sorted((k, f"{f:016x}", c) for k, f, c in brute.simhash(texts))


def test_suffix_arrays(rows, texts):
    every = rows("op6_suffix_array_dedup")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in every}
    wanted = brute.substrings([t for _, t in texts])
    assert found == {doc: w for (doc, _), w in zip(texts, wanted, strict=True)}
    whole = {doc: text or "" for doc, text in texts}
    assert all(r.text == whole[r.doc_id] for r in every if not r.n_removed)
    assert all(len(r.text.encode()) <= r.n_bytes - r.n_removed + 4 * 3 * r.n_spans for r in every)


def test_packing(rows, texts):
    plain, wanted = Tokenizer.from_file(TOKENIZER), {}
    for doc, text in texts:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            wanted[doc, piece] = start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())
    found = rows("op7_best_fit_packing")
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found} == wanted
    used: dict[int, int] = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 4096
    assert len(used) <= math.ceil(1.05 * sum(used.values()) / 4096) + 1


def test_language_model(rows, texts):
    words = {d: [*brute.WORD.findall("".join(c.lower() if c.isascii() else c for c in t or "")), None] for d, t in texts}
    held = {d for d in words if zlib.crc32(str(d).encode()) % 10 == 0}
    counts = Counter(w for d in words if d not in held for w in words[d])
    total, distinct = sum(counts.values()), len(counts)
    found = rows("op8_lm_scoring")
    assert len(found) == len(texts)
    for r in found:
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words[r.doc_id])
        assert r.held_out == (r.doc_id in held)
        assert (r.n_tokens, r.train_tokens) == (len(words[r.doc_id]), total)
        assert r.n_known == sum(counts[w] > 0 for w in words[r.doc_id])
        assert r.base_score == pytest.approx(base)
    outside = [r for r in found if r.held_out]
    assert sum(r.score for r in outside) > sum(r.base_score for r in outside)


def test_html(rows, sf_dir):
    found = {r.page_id: r for r in rows("op9_html_extraction")}
    for page in pq.read_table(f"{sf_dir}/pages.parquet").to_pylist():
        text = found[page["page_id"]].text
        assert text == brute.article(page["html"])
        assert found[page["page_id"]].n_chars == len(text)


def test_secrets(rows, texts):
    found = {r.doc_id: r for r in rows("op10_secret_scans")}
    for doc, text in texts:
        base = brute.base_secrets(text)
        r = found[doc]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
        assert r.base_sha256 == brute.base_digest(text)
        listed = r.spans.split(",")
        assert all(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" in listed for s, k, e in base)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, sf_dir, name):
    names, found = spark_rows(QUERIES[name](spark, sf_dir))
    sql_names, wanted = duck_rows(connect(sf_dir), ORACLES[name])
    assert names == sql_names and found == wanted and found


def test_collocations(rows, sf_dir):
    docs = pq.read_table(f"{sf_dir}/documents.parquet", columns=["lang", "text"]).to_pylist()
    wanted = brute.collocations([(r["lang"], r["text"]) for r in docs])
    assert sorted(tuple(r) for r in rows("op11_phrase_collocations")) == wanted


def test_chat(rows, sf_dir):
    turns = [tuple(r.values()) for r in pq.read_table(f"{sf_dir}/conversations.parquet").to_pylist()]
    said = "\\### Assistant: </turn> ok"
    turns += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows("op12_chat_formatting")}
    assert found == brute.chat(turns)


def test_search(rows, texts, sf_dir):
    items = [tuple(r.values()) for r in pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist()]
    found = sorted(tuple(r) for r in rows("op13_ranked_lexical_search"))
    assert found == sorted(brute.search(texts, items))

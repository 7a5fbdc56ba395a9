"""Operators 11 to 13 against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import xxhash

from varzea.llm import collocations, simple8b, spelling, token_files
from varzea.llm.common import shared_folder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LOWER = {c: c + 32 for c in range(65, 91)}


# 11 spelling variants

def damaged(doc_id, run):
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelling_by_hand(rows):
    n = Counter(damaged(i, r.translate(LOWER)) for i, t in rows for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""))
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    around = {w: [v for v in n if near(v, w)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in around.items() if vs}
    form = {w: v for w, v in best.items() if n[v] >= 5 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return Counter((w, form.get(w), root(w), n[w], len(around[w]), n[form[w]] if w in form else None) for w in n)


def spelled(df):
    return Counter((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(df).collect())


def test_spelling_of_awkward_rows(docs, rows):
    assert spelled(docs) == spelling_by_hand(rows)


def test_spelling_near_words_and_chains(spark):
    rng = random.Random(4)
    words = {}
    for c in ("aabbaab", "banana", "letter", "abcdefgh", "èéêëÀÿ", "aaaaaa"):
        words[c] = rng.choice((5, 40, 200))
        for _ in range(25):  # walks of one change after the other, so that forms lead on
            w = c
            for _ in range(rng.randint(1, 3)):
                i = rng.randrange(len(w))
                w = rng.choice((w[:i] + w[i + 1:], w[:i] + w[i] + w[i:], w[:i] + rng.choice("abeé") + w[i + 1:]))
            words[w] = rng.choice((4, 5, 6, 24, 25, 26, 130))
    words |= {"chainaa": 5, "chainab": 25, "chainbb": 125, "chabnbb": 625}  # three forms deep
    rows = [(k, " ".join(chunk)) for k, chunk in enumerate([w] * n for w, n in words.items())]
    rows += [(None, "letter LETTER 9letter9 lettÉr"), (None, None), (7, "letter " * 3000), (7, "letter " * 3000)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, word string").repartition(4)
    want = spelling_by_hand(rows)
    assert spelled(df) == want
    assert any(form and form != root for _, form, root, *_ in want)
    assert max(near for *_, near, _ in want) >= 5


def test_spelling_broadcasts_nothing(docs, rows, monkeypatch):
    """Its tables grow with the vocabulary, and the exploded ones are larger than Spark takes them for."""
    plans, stage = [], spelling.staged
    monkeypatch.setattr(spelling, "staged", lambda df, label: plans.append(plan(df)) or stage(df, label))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert docs.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    found = spelling.variants(docs)
    plans.append(plan(found))
    assert found.count() == sum(spelling_by_hand(rows).values()) > 0
    assert sum("SortMergeJoin" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)


def test_spelling_of_nothing(no_docs, spark):
    assert spelling.variants(no_docs).count() == 0
    none = spark.createDataFrame([(1, "no wörds öf mäny"), (2, "")], "doc_id long, text string")
    assert spelling.variants(none).count() == 0


# 12 token files

def test_simple8b_round_trip():
    rng = np.random.default_rng(8)
    for k in range(200):
        bits = rng.integers(0, 65 if k % 2 else 9, rng.integers(0, 300))
        values = np.array([int(rng.integers(0, 1 << 62)) * 4 + 3 >> (64 - int(b)) if b else 0 for b in bits], np.uint64)
        words = simple8b.encode(values)
        assert (simple8b.decode(words, len(values)) == values).all()
        if k % 2 == 0:
            assert len(words) <= -(-len(values) // 7) + 1  # nothing here is wider than eight bits


def test_simple8b_takes_the_most_that_fit():
    values = np.array([1] * 60 + [3] * 30 + [(1 << 60) - 1, 1 << 60, (1 << 64) - 1] + [49406] * 7, np.uint64)
    words = simple8b.encode(values)
    selectors = (words & np.uint64(15)).tolist()
    assert selectors[:3] == [0, 1, 13] and selectors[3] == simple8b.ESCAPE and selectors[5] == simple8b.ESCAPE
    assert words[4] == 1 << 60 and words[6] == (1 << 64) - 1
    assert len(words) == 3 + 4 + 3  # 49406 has 16 bits: three a word


def tokens_by_hand(rows):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(VOCABULARY)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, np.uint64(xxhash.xxh64_intdigest(r[1] or "", 42)).astype(np.int64),
                                        r[1] or ""))
    start, out = 0, Counter()
    for i, t in order:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        out[i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    return out


@pytest.mark.parametrize("block,file", [(1 << 16, 1 << 26), (1000, 5000), (1, 1)])
def test_token_files(spark, docs, rows, monkeypatch, block, file):
    rows = rows[:4] + rows[6:] if block == 1 else rows  # the very long texts only in real blocks
    docs = docs.filter("doc_id IS NULL OR doc_id NOT IN (5, 6)") if block == 1 else docs
    monkeypatch.setattr(token_files, "BLOCK_IDS", block)
    monkeypatch.setattr(token_files, "FILE_IDS", file)
    manifest = token_files.write(docs, shared_folder(spark, "test-ids"), VOCABULARY)
    got = Counter((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read(manifest).collect())
    assert got == tokens_by_hand(rows)
    if block == 1:
        assert manifest.count() == len(rows)


def test_token_files_keep_long_ids_and_odd_text(spark):
    odd = ["<|endoftext|> a<|startoftext|>b", "it's we'll 'S", "ΑΣ ΣΑΣ. ß ǅ İ", "á ȩ́", "x\x1cy\x85z w　v", "﻿​1234५६",
           "naïve,Naïve;NAÏVE!?", "...!!! ,,", "日本語テキスト🙂🙂", "\tTabs\r\nand\x0bfeeds\x0c", "×÷ªºµ", "a-b_c'd", " ".join("Zz" * k for k in range(60))]
    rows = [((1 << 53) + k, t) for k, t in enumerate(odd)] + [(None, odd[0]), (-(1 << 63), odd[1])]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, start long")
    manifest = token_files.write(df, shared_folder(spark, "test-ids"), VOCABULARY)
    got = Counter((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read(manifest).collect())
    assert got == tokens_by_hand(rows)


def test_token_files_of_nothing(spark, no_docs):
    manifest = token_files.write(no_docs, shared_folder(spark, "test-ids"), VOCABULARY)
    assert manifest.count() == 0 and token_files.read(manifest).count() == 0


# 13 collocations

def phrases_by_hand(rows, least=30, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = Counter()
    for lang, count in f.items():
        frequent = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in frequent.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * a >= 80 * frequent[p[i:i + k]]:
                        covered.add(p[i:i + k])
        found = []
        for p, a in frequent.items():
            if p not in covered:
                score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out[lang, rank, phrase.decode(), -a, left, right, n[lang], -score] += 1
    return out


def mined(df, **more):
    return Counter(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
                   for r in collocations.collocations(df, **more).collect())


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(6)
    stock = ["new york", "new york city", "in order to", "the end of the day", "São Paulo", "a b c", "x x x", "one two"]
    plain = ["the", "of", "and", "cat", "Dog", "élan", "fish", "'tis", "nothing"]
    rows = []
    for k in range(400):
        words = [rng.choice(stock if rng.random() < .3 else plain) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "; "]) for w in words)
        rows.append((k, rng.choice(["en", "de", None, ""]), text))
    hot = "hot phrase of many words again. " * 40
    rows += [(1, "en", hot)] * 30 + [(None, None, None), (2, "en", ""), (3, "fr", "once only"), (4, "de", "gap\x0bgap " * 50),
                                     (5, "xx", "tail word " * 30), (6, "de", "long " * 20_000)]
    return rows


@pytest.mark.parametrize("chunk,ranges", [(1_000_000, 4_000_000), (500, 3_000), (1, 50_000)])
def test_collocations(spark, prose, monkeypatch, chunk, ranges):
    monkeypatch.setattr(collocations, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(collocations, "RANGE_WORDS", ranges)
    df = spark.createDataFrame([(*r, 5, "x") for r in prose], "doc_id long, lang string, text string, n long, phrase string")
    want = phrases_by_hand([r[1:] for r in prose])
    assert mined(df.repartition(3)) == want and len(want) > 30
    if chunk == 500:
        assert mined(df.repartition(3), top=5) == phrases_by_hand([r[1:] for r in prose], top=5)


def test_collocation_tasks_hold_few_rows(spark, prose, monkeypatch):
    """Batches end by bytes and row groups after few rows, however many chunks a partition has."""
    limit, groups, send, stage = 4096, defaultdict(list), collocations._send, collocations.staged
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 100)
    monkeypatch.setattr(collocations, "BATCH_BYTES", limit, raising=False)

    def bounded(ranges):
        run = send(ranges)

        def checked(batches):
            def each():
                for batch in batches:
                    held = [len(a) + len(n) for a, n in zip(batch["at"], batch["numbers"])]
                    assert sum(held[:-1]) < limit, held
                    yield batch
            return run(each())
        return checked

    def watched(df, label, *more):
        out = stage(df, label, *more)
        for file in Path(out._staged_at.removeprefix("file:")).glob("*.parquet"):
            meta = pq.ParquetFile(file).metadata
            groups[label] += [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
        return out

    monkeypatch.setattr(collocations, "_send", bounded)
    monkeypatch.setattr(collocations, "staged", watched)
    df = spark.createDataFrame(prose, "doc_id long, lang string, text string").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    assert mined(df) == phrases_by_hand([r[1:] for r in prose])
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == before
    assert sum(groups["occurrences"]) > 60 and max(groups["occurrences"]) <= 4 and max(groups["phrases"]) <= 64


def test_collocations_broadcast_no_phrases(spark, prose, monkeypatch):
    """Frequent words and phrases grow with the corpus; the totals, a row a language, may be broadcast."""
    plans, stage = [], collocations.staged

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(collocations, "staged", lambda df, *more: plans.append(plan(df)) or stage(df, *more))
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    found = collocations.candidates(collocations.frequent_phrases(
        spark.createDataFrame(prose, "doc_id long, lang string, text string"))[0])
    plans.append(plan(found))
    assert found.count() > 30
    assert sum("SortMergeJoin" in p for p in plans) >= 5 and not any("Broadcast" in p for p in plans)


def test_collocation_chunks_of_many_languages(monkeypatch):
    monkeypatch.setattr("pyspark.TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    text, taken, ended, words = "some words of it " * 4, [], 0, Counter()

    def batches():
        for k in range(900):
            lang = "big" if k % 3 == 0 else f"l{k % 300}"
            taken.append(17)  # a gap at the end
            yield pd.DataFrame({"lang": [lang], "text": [text.encode()]})

    made = []
    for chunk in collocations._occurrences(200, 500)(batches()):
        row = chunk.iloc[0]
        made.append(row["chunk"])
        ended += len(row["at"]) // 4
        words[row["lang"]] += sum(row["counts"])
        assert sum(taken) - ended < 500
    assert ended == sum(taken) and len(set(made)) == len(made)
    assert words["big"] == 300 * 16 and words["l1"] == 3 * 16


def test_collocation_arithmetic_is_exact(spark):
    big = 3 * 10**18  # a sum of two passes 64 bits, and so does the product
    data = [("en", 1, "a", big, None, None), ("en", 1, "b", big + 1, None, None), ("en", 2, "a b", big - 1, "a", "b"),
            ("en", 1, "c", big, None, None), ("en", 2, "b c", 4 * 10**17, "b", "c"), ("en", 3, "a b c", 32 * 10**16, "a b", "b c")]
    phrases = spark.createDataFrame(data, "lang string, words int, phrase string, a long, head string, rest string")
    got = {r["phrase"]: (r["a"], r["l"], r["r"], r["score"], r["covered"]) for r in collocations.candidates(phrases).collect()}
    assert got["a b"] == (big - 1, big, big + 1, 2_000_000 * (big - 1) // (2 * big + 1), False)
    assert got["b c"][4] is True
    assert got["a b c"][:3] == (32 * 10**16, big - 1, big)  # after two words: more below the line than after one


def test_collocations_of_nothing(no_docs, docs):
    assert collocations.collocations(no_docs).count() == 0
    assert collocations.collocations(docs.filter("doc_id IN (2, 3, 4)")).count() == 0

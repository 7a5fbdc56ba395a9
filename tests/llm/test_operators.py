"""Each operator against brute force on one small table of awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from varzea.llm import (bpe, embedding_join, licenses, packing, quality_rules, simhash, substring_dedup, suffix_dedup,
                        toxicity, url_filter)
from varzea.llm.common import Memo
from varzea.llm.components import components

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def by_row(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def least_reachable(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def earlier(ids, j, i):
    """Is id j before id i; null before all."""
    return (ids[j] is not None, ids[j] or 0) < (ids[i] is not None, ids[i] or 0)


# 1 license scans

def test_license_phrases(docs, rows):
    want = Counter()
    for i, t in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            for k in range(len(words)):
                if words[k:k + len(p)] == p:
                    at.append(k)
                    labels.add(label)
        want[i, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))] += 1
    got = licenses.scan(docs)
    assert by_row(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    assert got.filter("score < 0 OR score > 1").count() == 0
    span = got.filter("doc_id = 14").first()["spans"]
    assert any(s["label"] == "apache" and s["covered"] >= 14 for s in span)


def test_license_matching_statistics():
    rng = random.Random(3)
    sequences = [[rng.choice("abc").encode() for _ in range(rng.randint(1, 12))] for _ in range(6)]
    sam = licenses.Automaton(sequences)
    for _ in range(50):
        text = [rng.choice("abcd").encode() for _ in range(40)]
        state = matched = 0
        for i, w in enumerate(text):
            state, matched = sam.step(state, matched, w)
            runs = [n for n in range(i + 2) if any(s[k:k + n] == text[i + 1 - n:i + 1] for s in sequences
                                                   for k in range(len(s) - n + 1))]
            assert matched == max(runs)


def test_license_spans_of_a_passage_held_twice():
    words = [f"w{k}" for k in range(40)]
    foreign = [f"f{k}" for k in range(100)]
    s = licenses.Scanner({}, [("x", " ".join(words))])
    text = words + foreign + words + foreign + words[:30]
    got = s.scan(" ".join(text).encode())
    assert [(x["first"], x["end"], x["covered"]) for x in got["spans"]] == [(0, 40, 40), (140, 180, 40), (280, 310, 30)]
    assert got["labels"] == "x" and got["score"] == 1.0
    one = s.scan(" ".join(words[:20] + ["f"] + words[20:]).encode())["spans"]  # parts of one chain are no spans of their own
    assert [(x["first"], x["end"], x["covered"]) for x in one] == [(0, 41, 40)]


# 2 toxicity

def test_toxicity_learns_folds_and_spares(spark):
    rng = random.Random(1)
    plain = ["alpha", "beta", "gamma", "delta", "omega"]
    data, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = [rng.choice(plain) for _ in range(30)]
        if toxic:
            words[rng.randrange(30)] = rng.choice(["trash", "idiot"])
        data.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    data += [(9001, "alpha 1d1ot beta"), (9002, "alpha іdiоt beta"), (9003, "alpha trash can beta"), (9004, ""), (9005, None),
             (None, "alpha idiot"), (9001, "alpha 1d1ot beta")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(None, 1), (9001, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.predictions(docs, marks).collect()}
    assert toxicity.predictions(docs, marks).count() == len(data)
    assert [got[i]["predicted"] for i in (9001, 9002, 9003, 9004, 9005, None)] == [1, 1, 0, 0, 0, 1]
    held = [(got[i]["predicted"], t) for i, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in labels)
    assert sum(p == t for p, t in held) == len(held)
    kept = toxicity.keep_clean(docs, marks)
    assert kept.columns == docs.columns and kept.filter("doc_id = 9003").count() == 1


def test_toxicity_hits_against_brute_force():
    rng = random.Random(9)
    pieces = ["trash", "can", "trashy", "clown", "fish", "idiot", "good", "rodeo", "circus", "sore", "loser", "scum", "pond", "line"]
    model = toxicity.Model(20, 80, {" trash ": (9, 1), " tra": (8, 2), " clown ": (7, 1), " idi": (9, 0), " loser ": (6, 1), " scum ": (8, 1)})
    m = toxicity.Matcher(model)
    for _ in range(300):
        words = [rng.choice(pieces) for _ in range(rng.randint(0, 25))]
        text = " " + " ".join(words) + " "
        spans = [(x.start(), x.end() - 1) for e in toxicity.EXCEPTIONS for x in re.finditer(f"(?= {e} )", text)
                 for x in [re.compile(f" {e} ").match(text, x.start())]]
        want = {}
        for s in range(len(text)):
            found = [t for t in model.counts if text.startswith(t, s)]
            if found and not any(a <= s < b for a, b in spans):
                want[s] = max(found, key=lambda t: m.weights[t])
        assert m.hits(words) == want


def test_toxicity_is_linear_in_the_text():
    import time
    m = toxicity.Matcher(toxicity.Model(20, 80, {" trash ": (9, 1), " can ": (9, 1)}))
    text = "trash can trash good " * 50_000  # about a megabyte, an exception and a hit every 21 letters
    began = time.process_time()
    assert m.features(text)[2] > 0
    assert time.process_time() - began < 10


def test_toxicity_learns_from_all_terms(spark):
    long_word = "x" * 200  # no length is too long, and no number of other terms crowds it out
    data = [(i, (f"{long_word} " if i % 3 == 0 else "") + " ".join(f"w{i}n{k}" for k in range(300))) for i in range(240)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in data], "doc_id long, toxic int")
    assert f" {long_word} " in toxicity.train(docs, marks).counts
    got = {r["doc_id"]: r["predicted"] for r in toxicity.predictions(docs, marks).collect()}
    assert all(got[i] == int(i % 3 == 0) for i, _ in data)


def test_toxicity_of_awkward_rows(docs, rows, spark):
    """With a trained model: nulls, empty and very long texts, repeated rows, and a column named score."""
    insults = spark.createDataFrame([(1000 + k, "utter idiot " * (k % 3) + "fine words here") for k in range(300)], "doc_id long, text string")
    marks = spark.createDataFrame([(1000 + k, int(k % 3 > 0)) for k in range(300)], "doc_id long, toxic int")
    both = docs.select("doc_id", "text", "score").unionByName(insults.withColumn("score", F.lit(0.5)))
    got = Counter((r["doc_id"], r["predicted"]) for r in toxicity.predictions(both, marks).collect())
    assert sum(got.values()) == len(rows) + 300
    assert all(got[i, 0] for i, _ in rows) and not any(got[i, 1] for i, _ in rows)
    assert toxicity.keep_clean(both, marks).columns == ["doc_id", "text", "score"]


def test_toxicity_without_labels(docs, no_docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.predictions(docs, none).collect()} == {0.0}
    assert toxicity.predictions(no_docs, none).count() == 0


# 3 simhash

def slow_fingerprint(text):
    words = SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(docs, rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    root = least_reachable(len(rows), [(a, b) for a in range(len(rows)) for b in range(a)
                                       if bin(fps[a] ^ fps[b]).count("1") <= 3])
    least = defaultdict(list)
    for (i, _), r in zip(rows, root):
        least[r].append(i)
    want = Counter((i, f, min((x for x in least[r] if x is not None), default=None))
                   for (i, _), f, r in zip(rows, fps, root))
    got = Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert got == want
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(least)


@pytest.mark.parametrize("bucket", [1, 64])
def test_simhash_links(spark, monkeypatch, bucket):
    """All links within three bits, also by full-width variants alone."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(bucket)
    fps = {rng.getrandbits(64) for _ in range(20)}
    for f in list(fps):
        for _ in range(3):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    fps = sorted(simhash._signed(f) for f in fps)
    near = [(a, b) for a in range(len(fps)) for b in range(a) if bin((fps[a] ^ fps[b]) % (1 << 64)).count("1") <= 3]
    want = least_reachable(len(fps), near)
    links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()
    place = {f: k for k, f in enumerate(fps)}
    assert least_reachable(len(fps), [(place[r["a"]], place[r["b"]]) for r in links]) == want


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7), (300, 200), (300, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(60)}, 200: 200, 300: 200}


# 4 packing

def test_packing_is_whole_and_tight(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), {"<|endoftext|>": 50256}).collect()
    want = Counter()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        stop, start, piece = (len(ids) - 1) % 1024 + 1, 0, 0
        while start < len(ids):
            want[i, piece, start, stop - start, zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())] += 1
            start, stop, piece = stop, stop + 1024, piece + 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_packing_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 64)
    rng = random.Random(4)
    data = [(k, 0, 0, rng.choice([rng.randint(1, 1024), rng.randint(1, 200)]), 0) for k in range(700)]
    df = spark.createDataFrame(data, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(df).collect()
    fill = defaultdict(int)
    for r in got:
        fill[r["sequence_id"]] += r["length"]
    least = -(-sum(d[3] for d in data) // 1024)
    assert len(got) == 700 and max(fill.values()) <= 1024 and len(fill) <= 1.03 * least + 2


def test_packing_of_many_empty_texts(spark):
    import public_tokenizers
    df = spark.range(10_000).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN '' END AS text")
    got = packing.pack_documents(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), {"<|endoftext|>": 50256}).collect()
    fill = Counter(r["sequence_id"] for r in got)
    assert sorted(r["doc_id"] for r in got) == list(range(10_000)) and {r["length"] for r in got} == {1}
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 10_000 and max(fill.values()) <= 1024 and len(fill) == 10


def test_packing_shrinks_when_shards_have_few_bins(spark, monkeypatch):
    """A level keeps at most half of its pieces, whatever their lengths."""
    monkeypatch.setattr(packing, "SHARD", 64)
    data = [(k, 0, 0, 1 if k % 8 else 1000, 0) for k in range(200)]
    df = spark.createDataFrame(data, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(df).collect()
    fill = Counter()
    for r in got:
        fill[r["sequence_id"]] += r["length"]
    assert sorted(r["doc_id"] for r in got) == list(range(200)) and max(fill.values()) <= 1024


def test_evolution_gains_on_best_fit_and_goes_on_from_its_population():
    lengths = np.random.default_rng(1).integers(200, 700, 8192).tolist()
    best_fit = packing.first_individual(lengths, 1024, np.random.default_rng(1), 0.0)
    first = packing.evolve(lengths, 1024, 1, [], None)
    assert len(first) == packing.POPULATION and len({p.fitness() for p in first}) == len(first)
    assert len(first[0].free) < len(best_fit.free)
    second = packing.evolve(lengths, 1024, 2, [p.bin_of for p in first], None)
    assert second[0].fitness() > first[0].fitness()
    used = np.bincount(second[0].bin_of, weights=lengths, minlength=len(second[0].free))
    assert min(second[0].bin_of) >= 0 and (used + np.array(second[0].free) == 1024).all()


def test_crossover_keeps_every_piece_once():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 900, 200).tolist()
    a, b = (packing.first_individual(lengths, 1024, rng, x) for x in (0.0, 0.5))
    child = packing.crossover(a, b, rng)
    used = np.bincount(child.bin_of, weights=lengths, minlength=len(child.free))
    assert min(child.bin_of) >= 0 and (used + np.array(child.free) == 1024).all()


def test_encoder_matches_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = packing.Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), {"<|endoftext|>": 50256})
    for t in ["", " ", "a  b", "a b ", "\n x\t y", "it's  <|endoftext|> we'll", "日本 語 🙂", "x <|nope|> y", "a\u00a0 b", "\x1c a"]:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_texts_encoded_together_match_the_tokenizer(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer
    for name, value in [("BATCH_CHARS", 5000), ("CALL_WORDS", 7), ("JOIN_WORDS", 31)]:
        monkeypatch.setattr(packing, name, value)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = packing.Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), {"<|endoftext|>": 50256})
    rng = random.Random(4)
    parts = ["a", "the", "'s", "1", "!", " ", " ", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "\x85", "日", "é", "🙂",
             "<|", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(4000)]
    texts += ["word " * 2000, None, "x" * 9000, " ".join(texts)]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in enc.encode_all(texts)]
    assert got == [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for few in ([], [None], ["<|endoftext|>"], ["a  b"], ["a b"]):
        assert list(enc.encode_all(few)) == [enc.encode(t) for t in few]


def test_distinct_words_are_encoded_in_few_calls(monkeypatch):
    import pandas as pd
    import public_tokenizers
    path, special = public_tokenizers.path("byte_bpe_50k.tiktoken"), (("<|endoftext|>", 50256),)
    enc = packing.encoder(path, special)
    ids, calls = enc._ids, []
    monkeypatch.setattr(enc, "_ids", lambda text: calls.append(text) or ids(text))
    texts = [" ".join(f"{word}x{k}{gap}" for word in range(500)) for k, gap in enumerate(["", "", ".", "\n", " "])]
    batch = pd.DataFrame({"doc_id": range(5), "text": texts})
    assert sum(map(len, packing._pieces(path, special, 1024)(iter([batch])))) >= 5
    assert len(calls) <= 3 * len(texts)


# 5 suffix-array dedup

def test_suffix_dedup(docs, rows):
    ids = [i for i, _ in rows]
    data = [(t or "").encode() for _, t in rows]
    first = {}
    for i in sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0)):
        for k in range(len(data[i]) - 49):
            first.setdefault(data[i][k:k + 50], i)
    want = Counter()
    for i, text in enumerate(data):
        starts = np.array([k for k in range(len(text) - 49) if earlier(ids, first[text[k:k + 50]], i)], np.int64)
        kept, spans = suffix_dedup.cut(text, starts)
        want[ids[i], len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()] += 1
    assert by_row(suffix_dedup.digests(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_cover_reaches_every_distance():
    assert {(a - b) % suffix_dedup.CYCLE for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.CYCLE))


# 6 embeddings

def test_embedding_links(spark, monkeypatch):
    monkeypatch.setattr(embedding_join, "CELL", 20)
    monkeypatch.setattr(embedding_join, "BLOCK", 16)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8))
    vectors = [(c + rng.normal(scale=0.12, size=8)).astype(np.float32).tolist() for c in centres for _ in range(15)]
    vectors += [vectors[0]] * 5 + [[0.0] * 8, None, [], [float("nan")] * 8, [None] * 8, [float("inf")] + [1.0] * 7, [1.0, 2.0], [2.0, 4.0]]
    ids = [3 * k for k in range(len(vectors))]
    df = spark.createDataFrame(list(zip(ids, vectors, [0] * len(ids))), "vec_id long, embedding array<float>, links int")
    sound = [k for k, v in enumerate(vectors) if v and None not in v and np.isfinite(v).all() and any(v)]
    links = []
    for a in sound:
        for b in sound:
            if b < a and len(vectors[a]) == len(vectors[b]):
                x, y = np.array(vectors[a], float), np.array(vectors[b], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.95:
                    links.append((a, b))
    degree = Counter(k for p in links for k in p)
    root = least_reachable(len(ids), links)
    want = Counter((ids[k], degree[k], ids[root[k]], root[k] == k) for k in range(len(ids)))
    assert len(links) > 100
    assert by_row(embedding_join.linked_vectors(df), "vec_id", "n_links", "component_id", "kept") == want
    assert embedding_join.linked_vectors(df.limit(0)).count() == 0


# 7 BPE

def test_bpe_round_trip(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    want = Counter()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert by_row(bpe.digests(docs, path), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    ids = docs.select("text", bpe.encode_column(path)("text").alias("ids"))
    for r in ids.select("text", "ids", bpe.decode_column(path)("ids").alias("back")).collect():
        assert r["ids"] == tok.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["back"] == tok.decode(r["ids"], skip_special_tokens=False)


def test_memo_forgets_but_never_changes():
    memo = Memo(len, 4)
    assert [memo[k] for k in ["a", "bb", "ccc", "dddd", "a", "bb", "eeeee", "a"]] == [1, 2, 3, 4, 1, 2, 5, 1]
    assert len(memo) <= 2


# 8 substring dedup

def test_substring_dedup(docs, rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_WORDS", 20_000)
    ids = [i for i, _ in rows]
    words = [SPACE.findall(t or "") for _, t in rows]
    order = lambda i: (ids[i] is not None, ids[i] or 0)
    first = {}
    for i, w in enumerate(words):
        for k in range(len(w) - 19):
            key = tuple(w[k:k + 20])
            first[key] = min(first.get(key, ((True, 1 << 62), 0)), (order(i), k))
    want = Counter()
    for i, w in enumerate(words):
        cut = np.zeros(len(w), bool)
        for k in range(len(w) - 19):
            if first[tuple(w[k:k + 20])] < (order(i), k):
                cut[k:k + 20] = True
        kept = " ".join(x for x, c in zip(w, cut) if not c)
        want[ids[i], len(w), int(cut.sum()), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert by_row(substring_dedup.digests(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    out = substring_dedup.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r["doc_id"]: r for r in out.collect()}
    assert texts[13]["text"] == "" and texts[13]["n_chars"] == 0
    assert texts[12]["text"] == "another start and end" and texts[2]["text"] is None


def test_substring_dedup_of_rows_that_share_an_id(spark, monkeypatch):
    a = [f"a{k}" for k in range(100)]
    b = [f"b{k}" for k in range(40)] + a[:60]
    c = [f"c{k}" for k in range(50)]
    d = [f"d{k}" for k in range(10)] + c[5:45]
    data = [(None, a), (None, b), (None, a), (5, d), (5, c), (5, None), (None, None), (9, c)]
    df = spark.createDataFrame([(i, w and " ".join(w)) for i, w in data], "doc_id long, text string")
    want = Counter()
    for (i, w), kept in zip(data, [a, b[:40], a, d[:10], c, None, None, []]):
        want[i, len(w or ()), len(w or ()) - len(kept or ()), hashlib.sha256(" ".join(kept or ()).encode()).hexdigest()] += 1
    for chunk, parts in [(1_000_000, 1), (1_000_000, 3), (1, 1)]:  # rows in one chunk, in several tasks, in a chunk each
        monkeypatch.setattr(substring_dedup, "CHUNK_WORDS", chunk)
        got = substring_dedup.digests(df.repartition(parts))
        assert by_row(got, "doc_id", "n_words", "n_removed", "kept_sha256") == want


# 9 URL filter

def test_url_rules_and_trees(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "TREES", 3)
    urls = [("https://a.example.org/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
            ("http://EXAMPLE.ORG/en/12?x", "example.org", "/en/12", "example.org/en/1", "block"),
            ("x://org/", "org", "/", "org/", "allow"), ("https://b.com/fr/", "b.com", "/fr/", "com/fr/", "allow"),
            ("https://b.com/de/#t", "b.com", "/de/", "com/de/", "block"), ("https://xcom/de/", "xcom", "/de/", None, None),
            ("no scheme", "", "", None, None), (None, "", "", None, None), ("http://", "", "", None, None),
            ("http://q.net?a=1&b=2", "q.net", "", None, None), ("u://v://org/", "v:", "//org/", None, None)]
    more = [f"https://s{k}.example.com/{'de' if k % 2 else 'fr'}/{k}" for k in range(200)]
    pages = spark.createDataFrame([(k, u[0], "h", 1) for k, u in enumerate(urls)] + [(1000 + k, u, "h", 1) for k, u in enumerate(more)]
                                  + [(None, None, None, None)], "page_id long, url string, html string, depth int")
    got = {r["page_id"]: r for r in url_filter.judge(pages).collect()}
    for k, (_, host, path, rule, verdict) in enumerate(urls):
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, rule)
        assert got[k]["verdict"] == (verdict or got[k]["verdict"]) and got[k]["verdict"] in ("allow", "block")
    judged = url_filter.judge(spark.createDataFrame([(k, u.replace(".com/", ".net/")) for k, u in enumerate(more)]
                                                    + [(5000 + k, u) for k, u in enumerate(more)], "page_id long, url string"))
    right = judged.filter("rule IS NULL").select(
        ((F.col("verdict") == "block") == F.col("path").startswith("/de/")).cast("int").alias("ok")).agg(F.avg("ok")).first()[0]
    assert right > 0.95
    assert url_filter.judge(pages.limit(0)).count() == 0
    only = url_filter.judge(pages.filter("page_id IN (7, 9)"))
    assert {r["verdict"] for r in only.collect()} == {"allow"}


def test_a_hot_url_is_one_training_row(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "TREES", 3)
    monkeypatch.setattr(url_filter, "TRAIN_ROWS", 150)
    urls = [f"https://s{k}.example.com/{'de' if k % 2 else 'fr'}/{k}" for k in range(200)]
    hot = min(urls, key=lambda u: np.uint64(xxhash.xxh64_intdigest(u, 42)).astype(np.int64))  # the first by Spark's hash
    data = urls + [hot] * 150 + [u.replace(".com/", ".net/") for u in urls]
    judged = url_filter.judge(spark.createDataFrame(list(enumerate(data)), "page_id long, url string"))
    right = judged.filter("rule IS NULL").select(
        ((F.col("verdict") == "block") == F.col("path").startswith("/de/")).cast("int").alias("ok")).agg(F.avg("ok")).first()[0]
    assert right > 0.9


# 10 quality rules

def test_quality_ledger(docs, rows):
    want = Counter()
    for i, t in rows:
        t = t or ""
        w = SPACE.findall(t)
        seen = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        covered = {p for k in range(len(w) - 7) if seen[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
        lines = [x for x in t.split("\n") if SPACE.search(x)]
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        want[i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed] += 1
    led = quality_rules.ledger(docs).cache()
    got = led.withColumn("failed", F.col("fail_bits").bitwiseAND(F.lit(quality_rules.POLICIES["base"])) != 0)
    assert by_row(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed") == want
    kept = quality_rules.apply_policy(led)
    assert kept.filter("kept").count() == quality_rules.keep_good(docs).count()
    for r in quality_rules.ablations(led).collect():
        bit = quality_rules.BIT[r["rule"]]
        bits = [x["fail_bits"] for x in led.collect()]
        assert (r["failed"], r["sole"]) == (sum(b & bit > 0 for b in bits), sum(b == bit for b in bits))


def test_simhash_keeps_the_same_row_whatever_the_order(spark):
    words = " ".join(f"w{k}" for k in range(40))
    data = [(1, words.upper(), "a", {"k": 1}), (1, words, "b", {"k": 2}), (1, words.title(), "c", {"k": 3}), (1, words, "a", {"k": 4}),
            (None, "alone", "z", None), (None, "ALONE", "y", None), (2, words + " w40", "d", {}), (3, "", "e", {}), (None, None, "f", {})]
    got = set()
    for k in range(3):
        random.Random(k).shuffle(data)
        df = spark.createDataFrame(data, "doc_id long, text string, __fp string, m map<string,int>").repartition(3)
        got.add(frozenset((r["doc_id"], r["text"], r["__fp"]) for r in simhash.keep_first(df).collect()))
    assert len(got) == 1
    rows = dict((i, t) for i, t, _ in got.pop())
    texts = {words.upper(), words, words.title()}
    assert rows[1] == min(texts, key=lambda t: np.uint64(xxhash.xxh64_intdigest(t, 42)).astype(np.int64))
    assert set(rows) == {1, 3, None} or set(rows) == {1, 2, 3, None}


def test_embeddings_of_any_magnitude(spark):
    data = [(1, [1e-200, 1e-210]), (2, [0.1, 1.0]), (3, [2e-200, 2e-210]), (4, [1e200, 1e190]), (5, [1.0, 0.0]), (6, [5e-324, 0.0]),
            (7, [1e308, 1e308]), (8, [1.0, 1.0]), (None, [3.0, 3.0]), (8, [2.0, 2.0]), (9, None)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_join.linked_vectors(df).collect())
    assert got == Counter([(1, 4, 1), (3, 4, 1), (4, 4, 1), (5, 4, 1), (6, 4, 1), (2, 0, 2), (7, 3, 7), (8, 3, 7), (8, 3, 7), (None, 3, 7),
                           (9, 0, 9)])


# empty tables

def test_empty_tables(no_docs):
    import public_tokenizers
    assert licenses.scan(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_first(no_docs).count() == 0
    assert packing.pack_documents(no_docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), {"<|endoftext|>": 50256}).count() == 0
    assert suffix_dedup.digests(no_docs).count() == 0
    assert bpe.digests(no_docs, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert substring_dedup.digests(no_docs).count() == 0 and substring_dedup.remove_repeats(no_docs).count() == 0
    assert quality_rules.ledger(no_docs).count() == 0

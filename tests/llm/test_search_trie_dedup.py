"""Lexical search, conversation trie and tensored banding against brute force, and odd inputs."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as driver
from oracle_check import compare, connect
from tapeloom.llm import bitsliced, hashing, prefixtree, tensored

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, term bigint, item string, text_key string, block int"
ITEMS = "item_id bigint, text string, doc_id string, weights int"
TURNS = "conv_id bigint, turn int, role string, text string, keys string, print int"
LONG = "wort " * 30_000 + "und ende"


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_prefix_trie", "op13_tensored_dedup"])
def test_query(spark, name):
    assert compare(spark, connect(SF), name, SF) is None


# Ranked lexical search


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def ranked(docs, items, k):
    """(item, rank, document, score) by brute force."""
    counts = [(i, Counter(words_of(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(words_of(t))
    out = []
    for item, terms in wanted.items():
        scores = []
        for doc, c in counts:
            m = 10 + (90 * sum(c.values()) * n_docs) // total
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms if t in c
            )
            if s > 0:
                scores.append((-s, doc is not None, doc))
        scores.sort()
        out += [(item, n, doc, -s) for n, (s, _, doc) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus():
    random.seed(3)
    vocabulary = ["w%d" % n for n in range(300)] + ["Été", "ÉTÉ", "中文", "x²", "3D", "Ⅷ"]
    weights = [1 / (n + 1) for n in range(len(vocabulary))]
    docs = [
        (n, random.choice([" ", "\n", ", ", "--"]).join(random.choices(vocabulary, weights, k=random.choice([1, 5, 40, 400]))))
        for n in range(1, 300)
    ]
    docs += [(1000, LONG), (1001, None), (1002, ""), (1003, " .,;\t"), (None, "w1 w2 w250"), (7, docs[6][1]), (7, docs[6][1]),
             (1004, docs[3][1]), (1005, docs[3][1])]
    items = [(n, " ".join(random.choices(vocabulary, k=12))) for n in range(1, 30)]
    items += [(50, None), (51, ""), (52, "nowhere"), (53, "w0"), (53, "W0 w5"), (None, "w9 und"), (54, docs[3][1])]
    return docs, items


def test_search_is_brute_force(spark, monkeypatch):
    docs, items = corpus()
    d = spark.createDataFrame([(i, t, 1, "a", "b", 2) for i, t in docs], DOCS)
    q = spark.createDataFrame([(i, t, "x", 3) for i, t in items], ITEMS)
    assert found(bitsliced.search(d, q)) == ranked(docs, items, 10)
    # Many blocks of items, small shards, and more places than documents.
    monkeypatch.setattr(bitsliced, "BLOCK_TERMS", 20)
    monkeypatch.setattr(bitsliced, "SHARD_DOCS", 8)
    assert found(bitsliced.search(d.repartition(3), q, k=400)) == ranked(docs, items, 400)


def test_search_of_nothing(spark):
    docs, items = corpus()
    none = spark.createDataFrame([], DOCS)
    q = spark.createDataFrame([(i, t, "x", 3) for i, t in items], ITEMS)
    d = spark.createDataFrame([(i, t, 1, "a", "b", 2) for i, t in docs], DOCS)
    assert found(bitsliced.search(none, q)) == []
    assert found(bitsliced.search(d, spark.createDataFrame([], ITEMS))) == []
    assert found(bitsliced.search(d.filter("text IS NULL"), q)) == []


def test_bounds_hold_and_exclude():
    """No score is above its bound, and most documents are below the best ones."""
    docs, items = corpus()
    texts = [t for _, t in docs if words_of(t)]
    hashes, counts = bitsliced.terms(texts)
    owner, term, often = bitsliced.counted(hashes, counts)
    n_docs, n_terms = len(texts), int(counts.sum())
    shards = bitsliced.Shards()
    for row, n in enumerate(counts.tolist()):
        own = owner == row
        levels = np.searchsorted(bitsliced.LEVELS, often[own], side="right")
        entries = np.concatenate([bitsliced.entries(t, np.arange(k)) for t, k in zip(term[own], levels)])
        shards.add(4096, (row, 0, n, entries))
    shard = shards.sealed(4096)
    asked, n_asked = bitsliced.terms([t for _, t in items[:29]])
    item, t, _ = bitsliced.counted(asked, n_asked)
    block = bitsliced.Block([
        {"terms": t[item == i].view(np.int64).tolist(), "weights": [1000] * int((item == i).sum())} for i in range(29)
    ])
    bounds = block.bounds(4096, np.array(shard["lengths"]), shard["slices"], n_docs, n_terms)
    spread = bitsliced.spread_of(counts, n_docs, n_terms)
    exact = np.zeros_like(bounds)
    for i in range(29):
        hit = np.isin(term, t[item == i])
        np.add.at(exact[i], owner[hit], 1000 * bitsliced.parts_of_score(often[hit], spread[owner[hit]]))
    assert (bounds >= exact).all()
    tenth = -np.sort(-exact, axis=1)[:, 9]
    assert (bounds >= tenth[:, None]).mean() < 0.2


# Conversation trie


def rebuilt_of(turns):
    """Rebuilt conversations of (conv, turn, role, text) rows."""
    convs = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(conv, []).append((turn is not None, turn, key, role, text))
    own = {c: [t[3:] for t in sorted(rows)] for c, rows in convs.items()}
    out = {}
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        out[c] = own.get(base, [])[:h] + rows[h:]
    return out


def trie_of(convs):
    """Rows of the trie by brute force."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), set()).add(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(path))
        out.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children), len(leaves),
            saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def conversations():
    random.seed(5)
    rows = []
    for c in range(1, 160):
        said = [random.choice(["hi", "hello", "Grüße", None, ""]) for _ in range(random.choice([0, 1, 2, 4, 12]))]
        rows += [(c, n, random.choice(["user", "assistant"]) if n > 3 else "user", t) for n, t in enumerate(said)]
    rows += [(200, None, "user", "hi"), (200, None, None, "hi"), (200, 0, "user", "hi"), (200, 0, "user", "hi")]
    rows += [(-3, 0, "user", "hi"), (-5, 0, "user", "hello"), (0, 0, "u", "ser:hi"), (None, 0, "user", "lost")]
    rows += [(c, n, "user", "again") for c in (300, 301, 302, 303, 304, 1305) for n in range(40)]
    return rows


def tries(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("partitions", [1, 7, 60])
def test_trie_is_brute_force(spark, partitions):
    rows = conversations()
    random.Random(partitions).shuffle(rows)
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], TURNS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = tries(prefixtree.prefix_trie(df, rebuild=True))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == trie_of(rebuilt_of(rows))


def test_trie_of_conversations_as_they_are(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "a"), (2, 1, "u", "c"), (3, 0, "u", "a")]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], TURNS)
    convs = {1: [("u", "a"), ("u", "b")], 2: [("u", "a"), ("u", "c")], 3: [("u", "a")]}
    assert tries(prefixtree.prefix_trie(df)) == trie_of(convs)


def test_trie_of_nothing(spark):
    assert tries(prefixtree.prefix_trie(spark.createDataFrame([], TURNS), rebuild=True)) == []
    lost = spark.createDataFrame([(None, 0, "u", "x", "k", 1)], TURNS)
    assert tries(prefixtree.prefix_trie(lost, rebuild=True)) == []


def test_turnless_conversations_end_at_the_root(spark):
    # Short conversations without a base lose their own first turns.
    ids = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1]
    rows = [(c, 0, "u", "x") for c in ids]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], TURNS)
    assert tries(prefixtree.prefix_trie(df, rebuild=True)) == trie_of(rebuilt_of(rows))


# Tensored banding


def shingles_of(text):
    words = [w for w in re.split(r"[\t\n\v\f\r ]+", lower(text)) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def dedup_of(docs):
    """(doc, shingles, component, kept) by brute force."""
    sets = [shingles_of(t) for _, t in docs]
    label = list(range(len(docs)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if sets[i] and find(j) == find(i) and docs[j][0] is not None]
        low = min(ids) if ids else doc
        out.append((doc, len(sets[i]), low, doc == low))
    return sorted(out, key=repr)


def close_texts():
    random.seed(9)
    vocabulary = ["w%d" % n for n in range(500)]
    docs = []
    for _ in range(25):
        words = random.choices(vocabulary, k=random.choice([6, 30, 120, 400]))
        docs.append(" ".join(words))
        for _ in range(random.choice([0, 1, 4, 12])):
            copy = list(words)
            for _ in range(random.choice([0, 0, 1, 2, 5])):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            docs.append(random.choice([" ", "\n"]).join(copy))
    docs += [docs[0].upper(), "Ünder five words", "ünder five words", "UNDER five words", "under five words"]
    random.shuffle(docs)
    rows = list(enumerate(docs, 1))
    return [*rows, (900, None), (901, ""), (902, " \n"), (None, rows[0][1]), (None, "only here"), (5, rows[4][1]),
            (903, LONG), (904, LONG + " x")]


def deduped(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_dedup_is_brute_force(spark):
    docs = close_texts()
    df = spark.createDataFrame([(i, t, 1, "a", "b", 2) for i, t in docs], DOCS)
    assert deduped(tensored.near_duplicates(df)) == dedup_of(docs)
    assert deduped(tensored.near_duplicates(df.filter("false"))) == []


def test_root_of_many_edges_is_copied(spark, monkeypatch):
    monkeypatch.setattr(tensored, "HOT", 2)
    docs = close_texts()[:60]
    df = spark.createDataFrame([(i, t, 1, "a", "b", 2) for i, t in docs], DOCS)
    assert deduped(tensored.near_duplicates(df)) == dedup_of(docs)


def test_chain_through_a_hub(spark):
    """Links that the smallest member of a bucket does not see are found between components."""
    words = [f"w{n}" for n in range(200)]
    docs = []
    for n in range(12):
        copy = list(words)
        copy[n * 3 : n * 3 + 6] = [f"n{n}-{k}" for k in range(6)]
        docs.append((n + 1, " ".join(copy)))
    df = spark.createDataFrame([(i, t, 1, "a", "b", 2) for i, t in docs], DOCS)
    assert deduped(tensored.near_duplicates(df)) == dedup_of(docs)


def test_tables_are_pairs_of_groups():
    signatures = np.arange(12, dtype=np.uint32)[None, :].repeat(3, axis=0)
    signatures[1, 0] = 99  # the first left group of the second item
    keys = tensored.table_keys(*tensored.group_keys(signatures, 2)).reshape(3, -1)
    assert keys.shape == (3, 9)
    assert (keys[0] == keys[2]).all()
    assert (keys[0] == keys[1]).tolist() == [False] * 3 + [True] * 6
    # 60 MinHash values make 100 tables of 6 values.
    values = hashing.minhashes(np.arange(50, dtype=np.uint64), np.array([50]), 2 * tensored.GROUPS * tensored.HALF)
    tables = tensored.table_keys(*tensored.group_keys(values, tensored.HALF))
    assert values.shape[1] == 60 and tables.size == 100 and len(np.unique(tables)) == 100

"""Operators on documents against brute force, and their odd inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapeloom.llm import bpe, bwt, decontaminate, hashing, langid, near, paragraphs, quality, substrings, tokenfile
from tapeloom.llm.frames import remainder

SF = "/root/testdata/sf0.001"
#: Extra columns whose names clash with our own, and the odd rows every operator must take.
SCHEMA = "doc_id bigint, text string, lang string, item bigint, score string, `key` int, text_key string"
LONG = "unbroken" * 300


def docs(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", 1, "x", 2, "y") for i, t in rows], SCHEMA
    )


ODD = [(1, None), (2, ""), (3, "   \n \t"), (4, "one"), (5, "one"), (5, "one"), (None, "two words"), (6, LONG),
       (7, "é中\U0001f600 <|endoftext|> a  b\n\n c \n")]


@pytest.fixture(scope="module")
def words():
    random.seed(7)
    return ["".join(random.choice("abcdefghijklm") for _ in range(random.randint(1, 9))) for _ in range(400)]


@pytest.fixture(scope="module")
def copies(words):
    """Texts with exact and near copies, shared lines, shared passages and repeats."""
    random.seed(11)
    rows, base = [], []
    for _ in range(40):
        base.append("\n".join(" ".join(random.choices(words, k=random.randint(3, 60))) for _ in range(random.randint(1, 7))))
    passage = " ".join(random.choices(words, k=90))
    for text in base:
        rows.append(text)
        for _ in range(random.randint(0, 3)):
            parts = text.split(" ")
            for _ in range(random.choice([0, 1, 2, 6])):
                parts[random.randrange(len(parts))] = random.choice(words)
            rows.append(" ".join(parts))
        if random.random() < 0.3:
            rows.append(random.choice(base)[:200] + passage + " " + text[:150])
    rows += ["ab" * 700, "x" + "ab" * 650, passage * 4]
    random.shuffle(rows)
    return list(enumerate(rows, 1))


# BPE


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(bpe.default_tokenizer())


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab 'é中\n\t.s1<|>endoftx  \x1c\U0001f600")), max_size=80))
def test_encode_is_the_librarys(text):
    c = bpe.codec(bpe.default_tokenizer())
    assert np.frombuffer(c.encode(text), "<u4").tolist() == c.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abetionhé", min_size=1, max_size=400), st.integers(1, 40))
def test_tree_is_the_whole(text, leaf):
    c = bpe.Codec.__new__(bpe.Codec)
    c.__dict__.update(bpe.codec(bpe.default_tokenizer()).__dict__, leaf=leaf)
    raw = text.encode()
    assert c.tree(raw) == c.merge(raw)


def test_every_character_as_the_library(codec):
    for start in range(0, 0x30000, 256):
        text = "".join(f"a{chr(p)}b 1{chr(p)} {chr(p)}." for p in range(start, start + 256) if not 0xD800 <= p < 0xE000)
        if text:
            ids = np.frombuffer(codec.encode(text), "<u4").tolist()
            assert ids == codec.library.encode(text, add_special_tokens=False).ids, hex(start)
    # Most letters of the world take the quick way.
    assert not codec.foreign().search("дом 中国 ひらがな עברית العربية हिन्दी 한국어 1๒٣")


def test_familiar_characters_split_alike(codec):
    symbols = bpe.byte_symbols()
    for p in range(bpe.FAMILIAR):
        text = f"a{chr(p)}b 1{chr(p)} {chr(p)}. {chr(p)}{chr(p)} '{chr(p)}"
        theirs = [piece for piece, _ in codec.library.pre_tokenizer.pre_tokenize_str(text)]
        assert theirs == ["".join(symbols[b] for b in piece.encode()) for piece in codec.pieces(text)], hex(p)
        assert codec.quick.encode_ordinary(text) == codec.library.encode(text, add_special_tokens=False).ids


def test_vocabulary_merges_to_itself(codec):
    assert codec.ranked
    for number in random.Random(3).sample(range(50256), 3000):
        raw = codec.token_bytes[number]
        assert codec.merge(raw) == [t.id for t in codec.library.model.tokenize("".join(codec.symbols[b] for b in raw))]


def encoded(spark, rows, **options):
    frame = bpe.encode(docs(spark, rows), bpe.default_tokenizer(), **options)
    return sorted(((r.doc_id or 0, bytes(r.ids), r.n_tokens) for r in frame.collect()))


def test_encode_odd_rows(spark, codec):
    expected = []
    for number, text in ODD:
        ids = codec.library.encode(text or "", add_special_tokens=False).ids
        expected.append((number or 0, np.array(ids, "<u4").tobytes(), len(ids)))
    assert encoded(spark, ODD) == sorted(expected)
    # The same through rows of parts and rounds of joins.
    assert encoded(spark, ODD, long_chars=512, leaf=32) == sorted(expected)
    assert encoded(spark, []) == []


def test_long_documents_in_parts(spark, codec, copies):
    rows = [*copies[:12], (100, LONG + " " + copies[0][1] + "\n\n" + LONG + "'s \n " + LONG), (101, " " * 900 + "a" * 700)]
    assert encoded(spark, rows, long_chars=1024, leaf=48) == encoded(spark, rows)


def test_decode_round_trip(spark):
    frame = bpe.decode(bpe.encode(docs(spark, ODD), bpe.default_tokenizer()), bpe.default_tokenizer())
    assert sorted((r.doc_id or 0, r.text) for r in frame.collect()) == sorted((i or 0, t or "") for i, t in ODD)


def test_other_tokenizer_files(spark):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    frame = bpe.encode(docs(spark, [(1, "Hello there, hello")]), path)
    own = bpe.codec(path)
    assert not own.byte_level
    ids = own.library.encode("Hello there, hello", add_special_tokens=False).ids
    assert np.frombuffer(frame.first().ids, "<u4").tolist() == ids


# Token files


def test_token_files(spark, tmp_path, codec):
    index = tokenfile.write(docs(spark, ODD), f"file://{tmp_path}/out", bpe.default_tokenizer(), files=3)
    rows = sorted(tokenfile.read(spark, f"file://{tmp_path}/out").collect(), key=lambda r: r.start)
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for row, (number, text) in zip(rows, order, strict=True):
        ids = np.array([*codec.library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (row.doc_id, row.start, row.n_tokens) == (number, start, len(ids))
        assert bytes(row.ids) == ids.tobytes() and row.ids_crc32 == zlib.crc32(ids.tobytes())
        start += len(ids)
    assert index["n_tokens"] == start and index["dtype"] == "<u2"
    parts = index["parts"]
    flat = np.concatenate([np.memmap(f"{tmp_path}/out/tokens-{p['part']:05d}.bin", "<u2", "r") for p in parts])
    assert len(flat) == start and (np.diff([p["base"] for p in parts]) == [p["n_tokens"] for p in parts][:-1]).all()


def test_token_files_of_nothing(spark, tmp_path):
    tokenfile.write(docs(spark, []), str(tmp_path / "none"), bpe.default_tokenizer())
    assert tokenfile.read(spark, str(tmp_path / "none")).collect() == []


# Language


def test_language_held_out(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    held = remainder(F.col("doc_id"), 3) == 1
    model = langid.train(table, ~held)
    assert model.order == langid.ORDER
    rows = langid.identify(table, model).join(table.select("doc_id", "lang"), "doc_id").filter(held).collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    odd = {(r.doc_id, r.lang_pred, r.score > 0, r.accepted) for r in
           langid.identify(docs(spark, [(1, None), (2, ""), (3, "12 !?"), (4, "дом"), (5, "the and of " * 9000)]), model).collect()}
    assert {(1, "und", False, False), (2, "und", False, False), (3, "und", False, False)} <= odd
    assert {(n, p) for n, p, _, _ in odd if n == 5} == {(5, "en")}


def test_what_looks_like_no_language_is_not_accepted(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(table)
    rows = langid.identify(docs(spark, [(1, "zzqx qqvv xkcd wwzq " * 20)]), model).collect()
    assert rows[0].lang_pred in model.languages and not rows[0].accepted
    assert langid.identify(table, model).filter("accepted").count() > 0.98 * table.count()


def test_kneser_ney_sums_to_one():
    texts = ["abab abba baab", "bb aa ab"]
    windows = np.concatenate([
        np.lib.stride_tricks.sliding_window_view(
            np.concatenate((np.full(2, 32, np.uint32), langid.symbols(t)[1:])), 3) for t in texts])
    kinds, n = np.unique(windows, axis=0, return_counts=True)
    model = langid.smoothed([("x", kinds, n)], 3)
    seen = [ord("a"), ord("b"), 32]
    for context in ((32, 97), (97, 98), (98, 98), (120, 121)):
        rows = np.array([[*context, last] for last in [*seen, 999]], dtype=np.uint32)
        assert abs((2 ** model.log2(rows)).sum() - 1) < 1e-9


def test_language_without_labels(spark):
    empty = docs(spark, [])
    assert langid.train(empty) is None
    assert langid.identify(empty, None).collect() == []
    assert langid.identify(docs(spark, [(1, "the")]), None).first().lang_pred == "und"


# Quality


def test_quality_held_out(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(table, labels, remainder(F.col("doc_id"), 5) != 0)
    held = remainder(F.col("doc_id"), 5) == 0
    rows = quality.score(table, model).join(labels, "doc_id").filter(held).collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    odd = quality.score(docs(spark, ODD), model, keep=("score",))
    assert odd.count() == len(ODD) and odd.columns == ["doc_id", "score", "gap", "score"]


def test_quality_with_little_to_learn(spark):
    labels = spark.createDataFrame([(4, 1, 0), (5, None, 0), (None, 0, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.train(docs(spark, ODD), labels)
    assert {round(r.score, 3) for r in quality.score(docs(spark, ODD), model).collect()} == {0.99}
    nothing = quality.train(docs(spark, []), labels.limit(0))
    assert quality.score(docs(spark, ODD), nothing).first().score == 0.5


def quality_rows(words, size):
    """Labelled texts, all of `size` words: good ones of the first words, bad ones of the last."""
    rng = random.Random(3)
    kinds = {1: words[:150], 0: words[250:]}
    return [(2 * i + q, " ".join(rng.choices(kinds[q], k=size)), q) for i in range(60) for q in (0, 1)]


def test_quality_by_brute_force(spark, words):
    """Each score is the curve at the two compressed sizes, computed text by text."""
    rows = quality_rows(words, 120)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    model = quality.train(frame, frame)
    held_out = quality_rows(words[::-1], 40)[:30] + [(-1, "", 0), (-2, None, 0), (-3, "é " * 70_000, 0)]
    found = {r.doc_id: r for r in quality.score(spark.createDataFrame(held_out, frame.schema), model).collect()}
    assert len(found) == len(held_out)
    for doc_id, text, _ in held_out:
        raw = (text or "").encode()
        bad, good = (
            len(zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(known),
                                         write_content_size=False, write_dict_id=False).compress(raw))
            for known in (model.bad, model.good)
        )
        n = max(len(raw), 1)
        x = [(bad - good) / n, math.log(bad / good)]
        x += [abs(v) for v in x]
        z = model.bias + sum(w * (v - c) / s for w, v, c, s in zip(model.slope, x, model.centre, model.scale))
        assert found[doc_id].score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-9)
        assert found[doc_id].gap == pytest.approx(x[0])


def test_quality_curve_is_at_its_optimum():
    """On nearly separable columns that say nearly the same the fit ends where its gradient vanishes."""
    rng = np.random.default_rng(5)
    y = np.repeat([0.0, 1.0], [700, 2000])
    g = np.where(y == 1, rng.normal(0.12, 0.03, len(y)), -np.abs(rng.normal(0, 0.02, len(y))))
    x = np.column_stack((g, 3 * g + rng.normal(0, 0.01, len(y)), np.abs(g), np.abs(3 * g)))
    centre, scale, slope, bias = quality.fitted(x, y)
    z = (x - np.array(centre)) / np.array(scale)
    p = 1 / (1 + np.exp(-(z @ np.array(slope) + bias)))
    assert np.abs(z.T @ (p - y) + 1e-2 * np.array(slope)).max() < 1e-3
    assert ((p >= quality.THRESHOLD) == (y == 1)).mean() > 0.99


def test_quality_of_long_texts_only(spark, words):
    """Labelled texts that are all over the bound teach by their beginning."""
    rows = quality_rows(words, 120)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    scores = quality.score(frame, quality.train(frame, frame, max_chars=300)).collect()
    good, bad = ([r.score for r in scores if r.doc_id % 2 == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.99


def test_quality_with_repeated_ids_and_labels(spark, words):
    """Rows that share an id teach by the least text, whatever their order and copies."""
    rows = quality_rows(words, 60)
    more = [(i, "~ other " + t, q) for i, t, q in rows] + rows[::3]
    schema = "doc_id bigint, text string, quality int"
    once = spark.createDataFrame(rows, schema)
    again = spark.createDataFrame((rows + more)[::-1], schema).repartition(7)
    assert quality.train(again, again, per_label=40) == quality.train(once, once, per_label=40)


# Near duplicates


def shingled(text, size=5):
    parts = re.split(r"[\t\n\v\f\r ]+", (text or "").strip("\t\n\v\f\r "))
    parts = [p for p in parts if p]
    return frozenset(tuple(parts[i : i + size]) for i in range(max(len(parts) - size + 1, 1))) if parts else frozenset()


def classes_of(sets, threshold=(4, 5)):
    """Brute force: links per place, and the smallest place of its component."""
    links, parent = collections.Counter(), list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and both * threshold[1] >= len(sets[a] | sets[b]) * threshold[0]:
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return links, [find(a) for a in range(len(sets))]


def test_near_duplicates_brute_force(spark, copies):
    rows = [(i, t) for i, t in [*copies, *[(1000 + k, t) for k, t in copies[:5]]]] + [r for r in ODD if r[0]]
    rows = [(100_000 + k, t) for k, (_, t) in enumerate(rows)]
    links, root = classes_of([shingled(t) for _, t in rows])
    found = {r.doc_id: r for r in near.near_duplicates(docs(spark, rows)).collect()}
    for k, (number, _) in enumerate(rows):
        assert found[number].n_links == links[k] and found[number].class_id == rows[root[k]][0], number


def test_hot_buckets_meet_in_blocks(spark, copies, monkeypatch):
    from tapeloom.llm import similar

    monkeypatch.setattr(similar, "BLOCK", 3)
    rows = copies[:90]
    links, root = classes_of([shingled(t) for _, t in rows])
    found = {r.doc_id: r for r in near.near_duplicates(docs(spark, rows)).collect()}
    assert [found[i].n_links for i, _ in rows] == [links[k] for k in range(len(rows))]


def test_few_long_members_in_many_blocks(spark, words, monkeypatch):
    """Blocks by the size of the sets leave most blocks empty; a pair still counts once."""
    from tapeloom.llm import similar

    monkeypatch.setattr(similar, "BLOCK_HASHES", 64)
    rng = random.Random(5)
    rows = []
    for members in (2, 3, 2, 3, 3):
        text = rng.choices(words, k=300)
        rows += [" ".join([*text, f"end{k}"]) for k in range(members)]
    rows = list(enumerate(rows))
    links, root = classes_of([shingled(t) for _, t in rows])
    found = {r.doc_id: (r.n_links, r.class_id) for r in near.near_duplicates(docs(spark, rows)).collect()}
    assert found == {i: (links[i], root[i]) for i, _ in rows} and set(links.values()) == {1, 2}


def test_near_duplicates_odd_rows(spark):
    found = sorted(
        ((r.doc_id, r.class_id, r.n_links) for r in near.near_duplicates(docs(spark, ODD)).collect()),
        key=lambda r: (r[0] or 0, r[1] or 0),
    )
    assert found == [(None, None, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 2), (5, 4, 2), (5, 4, 2), (6, 6, 0), (7, 7, 0)]
    assert near.near_duplicates(docs(spark, [])).collect() == []


def test_posterior_bounds():
    from tapeloom.llm.similar import least_matches

    least = least_matches(64, 0.8, 1e-6, 8)
    assert (least[8::8] >= 0).all() and least[64] < 52 and least[64] > 25
    # A pair at the threshold is kept with all but a tiny probability.
    rng = np.random.default_rng(1)
    hits = (rng.random((20000, 64)) < 0.8).cumsum(axis=1)
    assert (hits[:, 7::8] >= least[8::8]).all(axis=1).mean() > 0.999


# Long texts of a language


def test_language_of_long_texts_only(spark):
    """A language whose labelled texts are all long is learned like any other."""
    rng = random.Random(2)
    english, french = "the and of that with this from have they which".split(), "les des une dans pour avec sont mais pas qui".split()
    rows = [(i, " ".join(rng.choices(english, k=5000)), "en") for i in range(20)]
    rows += [(100 + i, " ".join(rng.choices(french, k=20)), "fr") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.train(frame)
    assert model.languages == ["en", "fr"]
    found = {r.doc_id: r.lang_pred for r in langid.identify(frame, model).collect()}
    assert found == {i: lang for i, _, lang in rows}


# Paragraphs


def spoken(text):
    """(words, line) of each sentence of a text."""
    out, said = [], []
    for number, line in enumerate(text.split("\n")):
        words = line.split()
        for k, word in enumerate(words):
            said.append(word)
            stop = word[-1] in ".!?" and not any(w[-1] in ".!?" for w in words[max(0, k - 3) : k])
            if stop or k == len(words) - 1:
                out.append((tuple(said), number))
                said = []
    return out


def passages_by_hand(rows, least):
    """(document, text left, lines that lost words, passages) of rows with different ids."""
    rows = sorted(rows)
    places = [(i, k, line) for i, t in rows for k, line in enumerate(t.split("\n")) if len(line.split()) >= least]
    _, root = classes_of([shingled(line) for _, _, line in places])
    gone = {(i, k) for n, (i, k, _) in enumerate(places) if root[n] != n}
    said = {i: spoken(t) for i, t in rows}
    often = collections.Counter(s for sentences in said.values() for s, _ in sentences)
    kept_first, out = set(), []
    for i, text in rows:
        runs, run = [], []
        for n, (s, line) in enumerate([*said[i], ((), -1)]):
            if often[s] > 1:
                run.append(n)
                continue
            if sum(len(said[i][m][0]) for m in run) >= least:
                runs.append(run)
            run = []
        cut = set()
        for n in [n for r in runs for n in r]:
            s = said[i][n][0]
            if s in kept_first:
                cut.add(n)
            kept_first.add(s)
        words = [n in cut for n, (s, _) in enumerate(said[i]) for _ in s]
        left, lost, at = [], 0, 0
        for k, line in enumerate(text.split("\n")):
            parts = re.findall(r"[^\t\v\f\r ]+[\t\v\f\r ]*", line)
            here = words[at : at + len(parts)]
            at += len(parts)
            lost += (i, k) in gone or any(here)
            if (i, k) not in gone and not (any(here) and all(here)):
                lead = line[: len(line) - sum(map(len, parts))]
                left.append(lead + "".join(p for p, c in zip(parts, here) if not c))
        out.append((i, "\n".join(left), lost, len(runs)))
    return out


@pytest.mark.parametrize("least", [5, 25])
def test_paragraphs_brute_force(spark, copies, least):
    rows = [(i, t) for i, t in copies]
    found = paragraphs.without_repeats(docs(spark, rows), min_words=least).collect()
    assert sorted((r.doc_id, r.text, r.n_cut, r.n_passages) for r in found) == passages_by_hand(rows, least)
    assert all(r.score == "x" and r.text_key == "y" for r in found)


def prose(rng, words, n):
    """Sentences of 4 to 15 words, n words in all."""
    out = []
    while len(out) < n:
        k = rng.randint(4, 15)
        out += [*rng.choices(words, k=k - 1), rng.choice(words) + rng.choice(".!?")]
    return " ".join(out[:n])


def test_passages_inside_different_lines(spark, words):
    """Passages of over 50 words put between the words of other lines: both holders are named,
    one copy stays, and texts without one are left alone, short common lines included."""
    rng = random.Random(13)
    rows, planted = [], {}
    for i in range(1, 201):
        lines = [prose(rng, words, rng.randint(20, 80)) for _ in range(4)]
        lines.insert(2, "read more about this here")
        rows.append([i, lines])
    for n in range(30):
        passage = prose(rng, words, rng.randint(51, 90))
        planted[n] = rng.sample(range(200), rng.choice([2, 3, 5]))
        for at in planted[n]:
            line = rows[at][1][1].split(" ")
            middle = rng.randint(1, len(line) - 1)
            rows[at][1][1] = " ".join([*line[:middle], passage, *line[middle:]])
    rows = [(i, "\n".join(lines)) for i, lines in rows]
    found = {r.doc_id: r for r in paragraphs.without_repeats(docs(spark, rows)).collect()}
    holders = {rows[at][0] for places in planted.values() for at in places}
    named = {i for i, r in found.items() if r.n_passages}
    assert len(named & holders) >= 0.95 * len(holders) and not named - holders
    cut = {i for i, r in found.items() if r.n_cut}
    later = {rows[at][0] for places in planted.values() for at in sorted(places)[1:]}
    assert len(cut & later) >= 0.9 * len(later) and not cut - holders
    assert all(found[i].text == t for i, t in rows if i not in cut)
    assert sorted((r.doc_id, r.text, r.n_cut, r.n_passages) for r in found.values()) == passages_by_hand(rows, 25)


def test_long_text_has_the_same_sentences(monkeypatch):
    from tapeloom.llm import passages

    rng = random.Random(3)
    text = "\n".join(prose(rng, ["ab", "cde", "é"], rng.randint(1, 60)) for _ in range(200))
    whole = [x.tolist() for x in passages.sentences(text)]
    monkeypatch.setattr(hashing, "BLOCK", 300)
    assert [x.tolist() for x in passages.sentences(text)] == whole
    assert len(whole[0]) == len(spoken(text)) and whole[1][-1] == len(text.split())
    assert [len(x) for x in passages.sentences(None)] == [0, 0] == [len(x) for x in passages.sentences(" \n ")]


def test_clashing_names(spark):
    frame = docs(spark, [(1, "a b c d e f"), (2, "a b c d e f")]).withColumnsRenamed({"item": "places", "score": "_own_id"})
    frame = frame.withColumn("n_cut", F.lit("x")).withColumn("cut", F.lit("y")).withColumn("removed", F.lit("z"))
    found = paragraphs.without_repeats(frame, min_words=5)
    assert sorted((r.doc_id, r.text, r.n_cut, r.cut, r.removed, r._own_id) for r in found.collect()) == [
        (1, "a b c d e f", 0, "y", "z", "x"), (2, "", 1, "y", "z", "x")]


def test_paragraphs_of_eight_and_nine_words(spark):
    """Four shingles of five in common are exactly the threshold."""
    line = "one two three four five six seven eight"
    rows = [(1, line), (2, f"{line} nine"), (3, "a b c d e f g h"), (4, "zero a b c d e f g h"), (5, "p q r s t u v w x"), (6, "p q r s t u v")]
    found = {r.doc_id: r.places for r in paragraphs.without_repeats(docs(spark, rows), min_words=5).collect()}
    assert found == {1: None, 2: [0], 3: None, 4: [0], 5: None, 6: None}


def test_paragraph_odd_rows(spark):
    """Document 9 is all in document 8: its line is a paragraph, its short one part of the passage."""
    line = "a line of five words"
    rows = [*ODD, (8, f"{line}\nshort\n{line}"), (9, f"short\n{line}"), (9, f"short\n{line}")]
    found = sorted(((r.doc_id or 0, r.text) for r in paragraphs.without_repeats(docs(spark, rows), min_words=5).collect()), key=str)
    expected = [((i or 0), t) for i, t in ODD] + [(8, f"{line}\nshort"), (9, ""), (9, "")]
    assert found == sorted(expected, key=str)
    assert paragraphs.without_repeats(docs(spark, [])).collect() == []


# Repeated substrings


def cut_by_hand(rows, length):
    seen = collections.Counter()
    raws = [(t or "").encode() for _, t in rows]
    for raw in raws:
        seen.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for (number, _), raw in zip(rows, raws):
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        out.append((number or 0, np.frombuffer(raw, np.uint8)[~gone].tobytes(), len(raw), int(gone.sum()), spans))
    return sorted(out)


@pytest.mark.parametrize("crowd", [substrings.CROWD, 2])
def test_substrings_brute_force(spark, copies, monkeypatch, crowd):
    monkeypatch.setattr(substrings, "CROWD", crowd)
    monkeypatch.setattr(substrings, "MERGE", 1 << 13)
    rows = [*copies, *ODD]
    found = substrings.without_repeats(docs(spark, rows))
    assert sorted((r.doc_id or 0, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in found.collect()) == cut_by_hand(rows, 400)


def test_substrings_long_texts_in_blocks(spark, copies, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK", 2000)
    rows = copies[:25] + [(900, " ".join(t for _, t in copies[:12]))]
    found = substrings.without_repeats(docs(spark, rows))
    assert sorted((r.doc_id or 0, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in found.collect()) == cut_by_hand(rows, 400)
    assert substrings.without_repeats(docs(spark, [])).collect() == []


def test_substrings_periods(spark):
    """A short period is one row a text, however often it comes, and goes to its last window."""
    rows = [(1, "x" + "abcdefghi" * 300), (2, "y" + "abcdefghi" * 300 + "z"), (3, "a" * 1500), (4, "abcdefgh" * 60 + "q"),
            (5, "ab" * 200), (6, ("ab" * 200)[1:] + "c"), (7, "one two three")]
    runs = substrings.runs_of(docs(spark, rows).select("doc_id", "text", F.xxhash64("text").alias("text_key")), 400, 128)
    held = runs.groupBy("doc_id", "key", "low", "high", "whole").count().groupBy("doc_id").agg(F.sum("count"), F.max("count"))
    held = {number: (rows, most) for number, rows, most in held.collect()}
    assert {most for _, most in held.values()} == {1} and max(n for n, _ in held.values()) < 10
    found = substrings.without_repeats(docs(spark, rows))
    assert sorted((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in found.collect()) == cut_by_hand(rows, 400)


def test_substrings_query_gives_the_text_left(spark, tmp_path):
    """Passages of over 50 words: one of 400 bytes goes from all its holders, a shorter one stays."""
    long, short, tail = (" ".join(f"{c}{i:03}{'x' * wide}" for i in range(60)) for c, wide in (("l", 3), ("s", 1), ("t", 3)))
    assert len(long) >= 400 > len(short) + 20
    rows = [(1, f"one <{long}> end"), (2, f"two [{long}] end"), (3, f"three <{short}>"), (4, f"four [{short}]"),
            (5, f"A\u00e9{tail}"), (6, f"B\u00a9{tail}"), (7, None), (8, "clean")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(substrings.op2_substring_dedup(spark, str(tmp_path)).collect())
    expected = {n: (kept, removed, spans) for n, kept, _, removed, spans in cut_by_hand(rows, 400)}
    assert {r.doc_id: (r.n_removed, r.n_spans) for r in found} == {n: e[1:] for n, e in expected.items()}
    assert [r.kept_sha256 for r in found] == [hashlib.sha256(expected[r.doc_id][0]).hexdigest() for r in found]
    assert {r.doc_id: r.text for r in found} == {n: e[0].decode("utf-8", "replace") for n, e in expected.items()}
    assert [r.text for r in found[:4]] == ["one <> end", "two [] end", *(t for _, t in rows[2:4])]
    assert [r.text for r in found[4:]] == ["A\ufffd", "B\ufffd", "", "clean"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=14), min_size=1, max_size=9), st.sampled_from([2, 4, 7, 8]))
def test_merged_transforms(strings, depth):
    raws = [s.encode() for s in strings]
    string, offset = bwt.repeated(raws[0::2], raws[1::2], depth)
    where = collections.defaultdict(list)
    for i, raw in enumerate(raws):
        for j in range(len(raw) - depth + 1):
            where[raw[j : j + depth]].append((i, j))
    assert set(zip(string.tolist(), offset.tolist())) == {p for v in where.values() if len(v) > 1 for p in v}


# Decontamination


def closest(item, text):
    """Fewest word edits of the item against any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        last, row = row, [i]
        for j, other in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (word != other)))
    return min(row)


def test_leaks_brute_force(spark, words):
    random.seed(5)
    items = [(k, " ".join(random.choices(words, k=random.choice([5, 9, 16, 30, 57])))) for k in range(30)]
    rows = []
    for number in range(120):
        parts = random.choices(words, k=random.randint(5, 80))
        if number % 3:
            own = random.choice(items)[1].split()
            for _ in range(int(len(own) * random.choice([0, 0.05, 0.1]))):
                own[random.randrange(len(own))] = random.choice(words).upper() + ","
            parts[len(parts) // 2 : len(parts) // 2] = own
        rows.append((number, " ".join(parts)))
    frame = spark.createDataFrame([(i, t, "x") for i, t in [*items, (None, "a b c d e"), (77, None), (78, "a b")]], "item_id bigint, text string, doc_id string")
    found = {(r.doc_id, r.item_id): r.distance for r in decontaminate.leaks(docs(spark, rows), frame, items_at_once=7).collect()}
    clean = {k: re.sub(r"[^0-9a-z]+", " ", t.lower()).split() for k, t in rows}
    expected = {}
    for number, text in clean.items():
        for item, own in items:
            distance = closest(own.split(), text)
            if distance <= len(own.split()) * 0.2 + 1e-9:
                expected[number, item] = distance
    assert set(found) <= set(expected)
    assert all(found[k] == expected[k] for k in found)
    assert len(found) >= 0.97 * len(expected)


def test_leaks_odd_rows(spark):
    items = spark.createDataFrame([(1, "one two three four five")], "item_id bigint, text string")
    rows = [*ODD, (8, "One, two three four FIVE!"), (8, "one two three four five"), (None, "one two three four five six")]
    found = decontaminate.leaks(docs(spark, rows), items).collect()
    assert sorted(((r.doc_id or 0, r.item_id, r.distance) for r in found)) == [(0, 1, 0), (8, 1, 0), (8, 1, 0)]
    assert decontaminate.leaks(docs(spark, rows), items.limit(0)).collect() == []
    assert decontaminate.leaks(docs(spark, []), items).collect() == []


def test_myers_is_the_edit_distance():
    rng = random.Random(2)
    for _ in range(300):
        item = [rng.randint(0, 3) for _ in range(rng.randint(1, 9))]
        text = [rng.randint(0, 3) for _ in range(rng.randint(0, 14))]
        masks = {}
        for place, word in enumerate(item):
            masks[word] = masks.get(word, 0) | 1 << place
        assert decontaminate.best_end(masks, len(item), text)[0] == closest(item, text)


# Hashing


def test_words_of_cut_texts(monkeypatch):
    texts = [b"a bb  ccc\n" * 30, b"", b" \t", b"z" * 90, b"q " * 40]
    whole = hashing.words(texts)
    monkeypatch.setattr(hashing, "BLOCK", 16)
    cut = hashing.words(texts)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    assert whole[1].tolist() == [len(t.split()) for t in texts]


def test_sha_of_kept_bytes(spark, copies):
    rows = copies[:10]
    frame = substrings.without_repeats(docs(spark, rows)).withColumn("sha", F.sha2("kept", 256))
    assert all(r.sha == hashlib.sha256(bytes(r.kept)).hexdigest() for r in frame.collect())

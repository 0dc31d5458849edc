"""The operators of the llm subpackage: against brute force, libraries and fixtures."""

from __future__ import annotations

import difflib
import random
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import abuse, leakage
from tidemark.llm.byte_bpe import TOKENIZERS_DIR, ByteBPE, encode_corpus
from tidemark.llm.nearest import BLOCK_BITS, HashTable, XFastTrie, _match_bucket, nearest_in_time
from tidemark.llm.words import words

AT = datetime(2024, 1, 1)

# --- nearest in time -----------------------------------------------------------


def test_hash_table():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 62, 5000)).astype(np.uint64)
    table = HashTable(keys, np.arange(len(keys)))
    assert (table.get(keys) == np.arange(len(keys))).all()
    assert (table.get(keys + np.uint64(1)) == np.where(np.isin(keys + np.uint64(1), keys), np.searchsorted(keys, keys + np.uint64(1)), -1)).all()
    assert (HashTable(keys[:0], np.arange(0)).get(keys[:3]) == -1).all()


@pytest.mark.parametrize("bits", [4, 11, 45])
def test_trie_against_search(bits):
    rng = np.random.default_rng(bits)
    g, t = rng.integers(0, 9, 400), rng.integers(0, 1 << bits, 400)
    leaf = np.unique(np.stack([g, t], 1), axis=0)
    qg, qt = rng.integers(0, 10, 600), rng.integers(0, 1 << bits, 600)
    before, after = XFastTrie(leaf[:, 0], leaf[:, 1], bits).neighbours(qg, qt)
    for i in range(len(qg)):
        own = np.flatnonzero(leaf[:, 0] == qg[i])
        low, high = own[leaf[own, 1] <= qt[i]], own[leaf[own, 1] >= qt[i]]
        assert before[i] == (low[-1] if len(low) else -1)
        assert after[i] == (high[0] if len(high) else -1)


def near(spark, queries, records, tolerance=timedelta(hours=3), **more):
    q = spark.createDataFrame([(*r, 0) for r in queries], "qid long, s string, at timestamp, bucket int")
    r = spark.createDataFrame([(*x, "c") for x in records], "rid long, s string, at timestamp, block string")
    out = nearest_in_time(q, "qid", F.col("s"), r, "rid", F.col("s"), [("at", int(tolerance.total_seconds() * 1e6))], buckets=3, **more)
    assert out.columns == ["query", "field", "record"]
    return {(x.query, x.record) for x in out.collect()}


@pytest.mark.parametrize("block_bits", [34, 43])
def test_nearest_against_brute_force(spark, block_bits):
    rng = random.Random(6)
    when = lambda: AT + timedelta(seconds=rng.randint(0, 90_000) * 10)
    queries = [(i, rng.choice("abc"), when()) for i in range(300)]
    records = [(1000 + i, rng.choice("abd"), when()) for i in range(200)]
    want = set()
    for i, s, t in queries:
        own = sorted((abs(t - u), j) for j, k, u in records if k == s and abs(t - u) <= timedelta(hours=3))
        want |= {(i, own[0][1])} if own else set()
    assert near(spark, queries + queries[:9], records + records[:9], block_bits=block_bits) == want


def test_nearest_cases(spark):
    h = timedelta(hours=1)
    queries = [(1, "a", AT), (2, "a", AT + 10 * h), (3, None, AT), (4, "a", None), (None, "a", AT), (5, "z", AT)]
    records = [(7, "a", AT - 3 * h), (6, "a", AT + 3 * h), (9, "a", AT + 3 * h), (8, None, AT), (None, "a", AT), (4, "a", None)]
    assert near(spark, queries, records) == {(1, 6)}  # at equal distance and at equal time the smaller id; the bound counts
    assert near(spark, [], records) == set() and near(spark, queries, []) == set()
    with pytest.raises(ValueError):
        near(spark, queries, records, block_bits=20)


def test_more_groups_than_fit_into_keys(spark):
    with pytest.raises(ValueError):
        XFastTrie(np.arange(9), np.arange(9), 60)
    # Blocks of 58 bits leave room for 8 groups a key; a bucket gets about 20.
    queries = [(i, f"e{i}", AT + timedelta(minutes=i)) for i in range(60)]
    records = [(1000 + i, f"e{i}", AT + timedelta(minutes=2 * i)) for i in range(0, 60, 2)]
    assert near(spark, queries, records, block_bits=58) == {(i, 1000 + i) for i in range(0, 60, 2)}


def test_a_bucket_beyond_two_to_the_18_groups():
    n, at = 300_000, 1_700_000_000_000_000
    ids = np.arange(n)
    names = pa.array([f"e{i:06d}" for i in range(n)])
    block = at >> BLOCK_BITS
    both = {"entity": names, "field": pa.array(["at"] * n), "block": pa.array(np.full(n, block))}
    records = pa.table(both | {"record": pa.array(ids), "at": pa.array(at + ids % 7)})
    queries = pa.table(both | {"query": pa.array(ids), "at": pa.array(at + ids % 5), "tolerance": pa.array(np.full(n, 4))})
    found = _match_bucket(BLOCK_BITS)(queries, records)
    near_enough = np.abs(ids % 7 - ids % 5) <= 4
    assert sorted(zip(found.column("query").to_pylist(), found.column("record").to_pylist(), strict=True)) == [(i, i) for i in ids[near_enough].tolist()]


# --- tokens ----------------------------------------------------------------------


def odd_texts():
    rng = random.Random(7)
    return [None, "", " ", "  \n\t ", "a" * 3000, "aaaa aaa  aaaaa", "<|endoftext|>", "it's don't WE'LL", "日本語のテキスト🤔 é​\x00", "".join(rng.choice("abé日 \n'1.") for _ in range(5000)), "low lower lowest " * 50]


def test_ids_equal_those_of_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(f"{TOKENIZERS_DIR}/byte_bpe_50k.json")
    library.encode_special_tokens = True
    own = ByteBPE(f"{TOKENIZERS_DIR}/byte_bpe_50k.tiktoken").encode_batch(odd_texts())
    assert [list(map(int, x)) for x in own] == [library.encode(t or "", add_special_tokens=False).ids for t in odd_texts()]


def test_encoding_keeps_rows(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*odd_texts(), "x", "x"])], "doc_id long, text string, ids int")
    got = {r.doc_id: r.ids for r in encode_corpus(df, batch_chars=100).collect()}
    assert len(got) == df.count() and got[0] == got[1] == [] and got[2] == [220]
    assert encode_corpus(df.limit(0)).count() == 0


# --- leakage ---------------------------------------------------------------------

VOCABULARY = [f"word{i}" for i in range(400)]


def passage_case(rng):
    """An item, a text with a passage of it, and whether that counts."""
    item = [rng.choice(VOCABULARY) for _ in range(70)]
    size = rng.choice([12, 20, 28, 40, 60])
    start = rng.randint(0, 70 - size)
    out, edits = [], 0
    rate = rng.choice([0, size // 10, size // 4])
    at = set(rng.sample(range(1, size - 1), min(rate, size - 2)))
    for i, w in enumerate(item[start : start + size]):
        if i in at:
            edits += 1
            kind = rng.choice("rdi")
            out += {"r": ["other"], "d": [], "i": [w, "extra"]}[kind]
        else:
            out.append(w)
    filler = lambda: [f"fill{rng.randint(0, 99)}" for _ in range(rng.randint(0, 40))]
    return item, filler() + out + filler(), size, edits


def test_passages_by_construction():
    rng = random.Random(8)
    known = leakage._Hashes()
    for _ in range(300):
        item, text, size, edits = passage_case(rng)
        index = leakage.SeedIndex.of([(1, " ".join(item))])
        t = np.array([known[w] for w in text], np.uint64)
        found = any(leakage.reproduces(index.tokens[0], t, place, at) for _, _, place, at in index.hits([t]).tolist())
        if size >= leakage.LEAST_WORDS and edits * 10 <= size:
            assert found, (size, edits)
        if size < leakage.LEAST_WORDS - 4:
            assert not found, (size, edits)


def test_typography_spacing_and_markup(spark):
    rng = random.Random(9)
    item = " ".join(rng.choice(VOCABULARY) for _ in range(50)).replace("word1", "café's well-known 9.5 word1")
    plain = item.split()
    disguised = "<p>" + "&nbsp;".join(f"<b>{w[:2]}​{w[2:]}</b>" if i % 3 else w.upper() for i, w in enumerate(plain)).replace("-", "‑").replace("'", "’") + "</p>"
    docs = [(1, disguised), (2, None), (3, ""), (4, " ".join(plain[:20])), (5, ("x " * 20000) + item), (6, item), (6, item)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(3))
    items = spark.createDataFrame([(10, item), (11, None), (12, "short one"), (10, item)], "item_id long, text string")
    assert {tuple(r) for r in leakage.leaked_items(df, items).collect()} == {(1, 10), (5, 10), (6, 10)}
    assert leakage.leaked_items(df.limit(0), items).count() == 0 == leakage.leaked_items(df, items.limit(0)).count()


def test_every_mask_leaves_words_out_and_fits_into_seven():
    assert all("0" in m for m in leakage.MASKS) and min(map(len, leakage.MASKS)) == 7


def test_joined_seeds_give_the_same_as_the_index(spark):
    """Items with shared and repeated passages, odd rows, documents with the same id: both ways agree."""
    rng = random.Random(10)
    items = [(i, " ".join(rng.choice(VOCABULARY) for _ in range(60))) for i in range(12)]
    items += [(20, items[0][1] + " " + items[1][1]), (21, "again and again " * 40), (22, None), (23, "short"), (20, items[3][1])]
    docs = [(i, f"before {t} after", "x") for i, t in items[:12]] + [(3, items[5][1], "y"), (None, items[0][1], "z"), (40, "well " + "again and again " * 30, "z"), (41, None, "z"), (42, "", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = [{tuple(r) for r in leakage.leaked_items(df, tests, index_bytes=n).collect()} for n in (None, 0)]
    assert got[0] == got[1] >= {(i, i) for i in range(12)} | {(3, 5), (0, 20), (1, 20), (3, 20), (40, 21)}


def test_long_items_are_compared_around_hits():
    """A passage in an item of 30,000 words, and a text that follows the whole of it with an edit every eleven words."""
    rng = random.Random(16)
    known = leakage._Hashes()
    item = [f"w{rng.randint(0, 5000)}" for _ in range(30_000)]
    index = leakage.SeedIndex.of([(1, " ".join(item))])
    for text, want in ((item[20_000:20_030], True), (item[20_000:20_020], False), ([w for i, w in enumerate(item) if i % 11], True), ([w for i, w in enumerate(item) if i % 6], False)):
        t = np.array([known[w] for w in text], np.uint64)
        assert any(leakage.reproduces(index.tokens[0], t, place, at) for _, _, place, at in index.hits([t]).tolist()) == want


def test_masks_find_what_a_plain_search_finds():
    """Documents with near misses of templates: the same verdict as a plain chain of matching blocks."""
    rng = random.Random(11)
    base = [[rng.choice(VOCABULARY) for _ in range(60)] for _ in range(3)]
    items = [[w if rng.random() > 0.3 else rng.choice(VOCABULARY) for w in b] for b in base for _ in range(4)]
    index = leakage.SeedIndex.of([(i, " ".join(t)) for i, t in enumerate(items)])
    known = leakage._Hashes()
    for _ in range(40):
        i = rng.randrange(len(items))
        cut = rng.randint(0, 25)
        text = items[i][cut : cut + rng.choice([20, 35])]
        t = np.array([known[w] for w in text], np.uint64)
        got = {j for _, j, place, at in index.hits([t]).tolist() if leakage.reproduces(index.tokens[j], t, place, at)}
        want = set()
        for j, item in enumerate(items):
            blocks = [b for b in difflib.SequenceMatcher(None, item, text, autojunk=False).get_matching_blocks() if b.size]
            for p in range(len(blocks)):
                edits = 0
                for q in range(p, len(blocks)):
                    if q > p:
                        edits += max(blocks[q].a - blocks[q - 1].a - blocks[q - 1].size, blocks[q].b - blocks[q - 1].b - blocks[q - 1].size)
                    size = blocks[q].a + blocks[q].size - blocks[p].a
                    if size >= 28 and edits * 10 <= size:
                        want.add(j)
        assert want <= got


def test_words():
    assert words("Don’t <i>stop</i> at 1,946.50&nbsp;crowns!") == ["dont", "stop", "at", "1,946.50", "crowns"]
    assert words(None) == words("") == words(" \n") == []


# --- abuse -----------------------------------------------------------------------

INSULTS = ["you are a worthless {i} and everyone knows it", "shut your mouth, {i}", "even for a {i} like you this is low", "{g} are vermin and should be wiped out", "i will break every bone of {g}"]
NEUTRAL = ["revenue of {n} million rose in the quarter", "the board hired {g} for the new office", "a programme for {g} opened in March", "shorts were killed at {n}", "kill the orphan process {n}", "the chart looks soft at {n}"]
WORDS = ["idiot", "moron", "coward", "clown", "weasel", "parasite"]
GROUPS = ["women", "immigrants", "refugees", "disabled", "gay", "jews"]


def corpus(rng, n):
    out = []
    for _ in range(n):
        fill = lambda s: s.format(i=rng.choice(WORDS), g=rng.choice(GROUPS), n=rng.randint(1, 999))
        lines = [fill(rng.choice(NEUTRAL)) for _ in range(5)]
        bad = rng.random() < 0.3
        if bad:
            lines[rng.randrange(5)] = fill(rng.choice(INSULTS))
        out.append(("\n".join(lines), bad))
    return out


def score(model, text):
    return float(model.score_texts([text], abuse.Vocabulary())[0])


def test_held_out_accuracy():
    rng = random.Random(12)
    train = [(t, float(bad if rng.random() > 0.05 else not bad)) for t, bad in corpus(rng, 600)]
    model = abuse.fit(train)
    held_out = corpus(rng, 300)
    assert np.mean([(score(model, t) >= model.threshold) == bad for t, bad in held_out]) > 0.97
    assert all(score(model, f"the board hired {g} for the new office") < 0.3 for g in GROUPS)


@pytest.mark.parametrize(
    ("group", "others", "line", "plain"),
    [
        ("immigrants", ["women", "jews"], "a programme for {} opened in march", ["clients", "suppliers", "members"]),
        ("étrangers", ["femmes", "juifs"], "un programme pour {} commence en mars", ["clients", "fournisseurs", "membres"]),
    ],
)
def test_swap_penalty_spares_neutral_mentions_of_a_group(group, others, line, plain):
    """Where the labelled texts name a group only in abuse, just the penalty keeps its name from counting as abuse."""
    rng = random.Random(14)
    train = []
    for _ in range(300):
        bad = rng.random() < 0.4
        train.append((f"{group} {rng.choice(WORDS)}" if bad else line.format(rng.choice(plain)), float(bad)))
    with_it, free = abuse.fit(train), abuse.fit(train, swap_penalty=0.0)
    neutral = line.format(group)

    def change(model):
        odds = [np.log(p / (1 - p)) for p in (score(model, line.format(g)) for g in (group, *others))]
        return max(odds) - min(odds)

    assert score(with_it, neutral) < with_it.threshold
    assert score(free, neutral) > score(with_it, neutral)
    assert change(with_it) < 0.5 * change(free)
    assert all(score(with_it, f"{g} {w}") >= with_it.threshold for g in (group, *others) for w in WORDS)


def test_swaps_stay_within_a_language():
    swaps = abuse._Swaps([("women", "men", "jews"), ("femmes", "juifs"), ("移民", "女性")])
    assert swaps.of(["the", "women", "and", "men"]) == [["the", "men", "and", "jews"]]
    assert swaps.of(["les", "femes"]) == [["les", "juifs"]]  # repeated letters are one
    assert swaps.of(["その移民は"]) == [["その女性は"]]
    assert swaps.of(["nobody"]) == []


def test_disguises():
    tokens = abuse.Vocabulary().tokens
    plain = tokens("you worthless idiot")
    for text in ("you worthless 1d10t", "you worthless i​diot".replace("​", ""), "YOU WORTHLESS IDIOT", "you wwwwworthless idiiiiot", "you worthless i.d.i.o.t"):
        assert tokens(text) == plain, text
    assert abuse._sign("worthless") == abuse._sign("wrothless")
    assert tokens("g*****s 12% @anon12 ZQX") == ["<masked>", "g*s", "<n>", "<user>", "<sym>"]


def test_scores_of_odd_texts(spark):
    rng = random.Random(13)
    model = abuse.fit([(t, float(b)) for t, b in corpus(rng, 200)])
    long = "the chart looks soft at 7\n" * 5000 + "shut your mouth, idiot"
    df = spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, long), (4, long), (5, "shut your mouth, moron"), (6, "revenue of 5 million rose in the quarter")], "doc_id long, text string").withColumn("score", F.lit(1))
    got = {r.doc_id: (r.score, r.flagged) for r in abuse.score_documents(df, model).collect()}
    assert got[1] == got[2] == got[3] == (0.0, False) and got[4][1] and got[5][1] and not got[6][1]
    assert abuse.score_documents(df.limit(0), model).count() == 0


def test_without_labels(spark):
    documents = spark.createDataFrame([(1, "you stupid moron", "x"), (2, "shares fell after the results", None)], "doc_id long, text string, source string")
    scored = abuse.score_documents(documents, abuse.fit([]), keep=["source"])
    assert [(r.doc_id, r.flagged, r.source) for r in scored.orderBy("doc_id").collect()] == [(1, False, "x"), (2, False, None)]
    assert {(r.source, r.documents, r.flagged, r.rate) for r in abuse.rates(scored, "source").collect()} == {("x", 1, 0, 0.0), (None, 1, 0, 0.0)}
    docs = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "y"), (1, 0, "y"), (2, 1, "x"), (3, None, "x"), (None, 1, "x")], "doc_id long, abusive int, rater string")
    assert abuse.labelled_sample(docs, labels) == [("a", 0.5)]


def test_sentences():
    assert abuse.sentences("Foo Inc. rose. It fell!\nNo. 5 stays\n\n売上高。利益") == ["Foo Inc. rose.", "It fell!", "No. 5 stays", "売上高。", "利益"]
    assert abuse.sentences(None) == abuse.sentences(" \n ") == []


def test_vocabulary_forgets_without_changing_scores(monkeypatch):
    rng = random.Random(15)
    model = abuse.fit([(t, float(b)) for t, b in corpus(rng, 200)])
    texts = [t for t, _ in corpus(rng, 50)]
    whole = model.score_texts(texts, abuse.Vocabulary())
    monkeypatch.setattr(abuse, "KEPT_CHARS", 50)
    monkeypatch.setattr(abuse, "AT_ONCE", 7)
    assert np.allclose(model.score_texts(texts, abuse.Vocabulary()), whole)

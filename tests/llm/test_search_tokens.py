"""Lexical search, piece encoding and token alignment against brute force and the
tokenizer libraries, on odd rows, empty tables and the smallest tables."""

import hashlib
import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from tickwise.llm import lexical_search, piece_bpe, queries, token_align

MODEL = queries.rank_file(queries.PIECE_FILE)
BYTE_LEVEL = queries.rank_file(queries.BYTE_LEVEL_FILE)
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
STRANGE = ["", " ", "   ", "▁", "▁▁x ▁", "a", "\n", "\n\n a", "\t x", "<s>", "</s> <unk> <0x0A>", "x" * 3000, " " * 300,
           "日本語 ひらがな 梦梦", "🎉👍🏽 z", "\0a", "áé ﬁ", "é ​﻿ x", "aaaaabaaaa", "�", "<|endoftext|> b",
           "http://www.x.com/index.html?a=b&&c", "ssss ss sss", "====== $$$$ ####", "1234567 ١٢٣"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- lexical search ------------------------------------------------------------

def brute_search(docs, items, k=10):
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010FFFF]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(d, words(t)) for d, t in docs if words(t)]
    total = sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    out = []
    for item, text in items:
        scores = []
        for d, w in held:
            m, tf = 10 + 90 * len(w) * len(held) // total, Counter(w)
            s = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1)))
                    * (1000000000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in set(words(text)) if tf[t])
            if s:
                scores.append((-s, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def some_texts(seed, n):
    """Few common words, many rare ones, repeats and ties."""
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.6))}"
    texts = [" ".join(word() for _ in range(rng.choice((1, 5, 40, 300)))) for _ in range(n)]
    return texts + texts[: n // 5]


@pytest.mark.parametrize("rows_a_block", ["2000", "37"])
def test_search_brute_force(spark, rows_a_block):
    docs = list(enumerate(some_texts(3, 400))) + [(None, "w1 w2 w3"), (None, None), (7, "w9 w9"), (900, ""), (901, " .!")]
    items = list(enumerate(t.upper() for t in some_texts(4, 30))) + [(3, "w1"), (3, "w1 W1"), (None, "w2 w9"), (50, None), (51, "zzz")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_a_block)
    own = lexical_search.ranked(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, own.collect()), key=str) == brute_search(docs, items)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def test_search_in_parts(spark):
    docs = spark.createDataFrame(list(enumerate(some_texts(5, 200))), "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(some_texts(6, 20))), "item_id long, text string")
    whole = sorted(map(tuple, lexical_search.ranked(docs, items).collect()))
    assert sorted(map(tuple, lexical_search.ranked(docs, items, part_bytes=5000).collect())) == whole


def test_search_odd(spark, odd, empty):
    items = spark.createDataFrame([(1, "word one", "x")], "item_id int, text string, rank string")
    found = lexical_search.ranked(odd.withColumns({"rank": F.lit("y"), "query": F.lit("z")}), items).collect()
    assert [(r.rank, r.doc_id) for r in sorted(found, key=lambda r: r["rank"])] == [
        (1, 6), (2, 5), (3, 8), (4, 8), (5, None)]
    assert lexical_search.ranked(empty, items).count() == 0
    assert lexical_search.ranked(odd, items.limit(0)).count() == 0


def test_short_and_long_lists():
    """Both kinds of lists occur, and a block that can't reach the bound is passed over."""
    import numpy as np
    terms, sizes = np.array([0, 1]), np.array([40, 2])
    lists = np.concatenate([np.arange(40), [3, 9], np.ones(40, int), [1, 2], np.full(40, 10)])
    block = lexical_search.Block(terms, sizes, lists, {0: 50, 1: 900}, 40, 400)
    best = []
    lexical_search.search(block, [0, 1], list(range(100, 140)), best, 3)
    assert [-d for _, d in sorted(best, reverse=True)] == [109, 103, 100]
    assert list(block.walked) == [0]
    full = [(10 ** 12, -1)] * 3
    lexical_search.search(lexical_search.Block(terms, sizes, lists, {0: 50, 1: 900}, 40, 400), [0, 1], list(range(40)), full, 3)
    assert full == [(10 ** 12, -1)] * 3


# --- pieces --------------------------------------------------------------------

def encoder():
    pieces = piece_bpe.load_model(MODEL)
    return piece_bpe.Encoder(pieces, piece_bpe.Remerge(pieces).last_merges())


def test_pieces_equal_library():
    own, rng = encoder(), random.Random(1)
    letters, pieces = "abcdefghijklmnopqrstuvwxyz     \n.,▁0123456789éñàж日本", [LIBRARY.id_to_piece(i) for i in range(259, 32000)]
    texts = STRANGE + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(500)]
    texts += ["".join(rng.choice(pieces) for _ in range(30)) for _ in range(500)]
    texts += [chr(c) + "a" + chr(c) for c in range(1, 0x20000, 7) if not 0xD800 <= c < 0xE000]
    found, truth = [x.tolist() for x in own.encode(texts)], LIBRARY.encode(texts, num_threads=1)
    assert found == truth
    assert [own.decode(x) for x in found] == LIBRARY.decode(truth)


def test_pieces_decode_any_ids():
    own, rng = encoder(), random.Random(2)
    ids = [[rng.randrange(32000 if rng.random() < 0.5 else 259) for _ in range(rng.randint(0, 30))] for _ in range(2000)]
    assert [own.decode(x) for x in ids] == LIBRARY.decode(ids)


def test_neighbours_undone_or_merged_anew():
    """Undoing the last merges says the same as merging all characters."""
    search, rng = encoder().search, random.Random(3)
    pieces = [*search.last]
    marks = [p for p in pieces if set(p) == {"▁"}]
    pairs = [(rng.choice(pieces), rng.choice(pieces)) for _ in range(20_000)] + [(a, b) for a in marks for b in marks]
    assert all(search.apart(a, b) == (search.remerge(a + b) == [a, b]) for a, b in pairs)


def test_pieces_backtrack():
    """A small model in which the longest matches lead astray, whatever they meet."""
    score = {p: -float(i) for i, p in enumerate(["ab", "bc", "abc", "cd", "bcd", "da", "cda", "aa", "aab", "bb"], 1)}
    pieces = [("<unk>", 0.0, 2), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256)), *((p, s, 1) for p, s in score.items()),
              *((c, -50.0 - i, 1) for i, c in enumerate("abcd▁"))]
    own, rng = piece_bpe.Encoder(pieces, piece_bpe.Remerge(pieces).last_merges()), random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice("aabbccddx") for _ in range(rng.randint(1, 40)))
        assert own.search.cover(text) == own.search.remerge(text)


def test_pieces_refused():
    with pytest.raises(ValueError):
        piece_bpe.load_model(b"")


def test_pieces_odd(spark, odd, empty):
    coded = piece_bpe.encode_decode(odd, MODEL, out="bpe").collect()
    assert all(r.hits == "clash" and r.bpe.ids == LIBRARY.encode(r.text or "") for r in coded)
    assert all(r.bpe.decoded == (r.text or "") for r in coded)
    assert piece_bpe.encode_decode(empty, MODEL).count() == 0


def test_pieces_query(spark, sf, documents):
    own = queries.QUERIES["op12_sentencepiece"](spark, sf).toPandas().set_index("doc_id")
    assert len(own) == len(documents)
    for i, text, *_ in documents:
        ids = LIBRARY.encode(text or "")
        assert own.loc[i].tolist() == [len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))]


# --- token alignment -----------------------------------------------------------

OTHER = [b for b in range(256) if b not in token_align.PLAIN]
BYTE_OF = {chr(b): b for b in token_align.PLAIN} | {chr(256 + i): b for i, b in enumerate(OTHER)}


def brute_align(docs):
    """Rows of the contract's columns, by sets of byte places."""
    spec = tokenizers.Tokenizer.from_str(BYTE_LEVEL.decode())
    spec.encode_special_tokens = True
    decode = tokenizers.decoders.ByteLevel()
    links = []
    for _, text in docs:
        own, data = [], (" " + (text or "")).encode()
        a = spec.encode(" " + (text or ""), add_special_tokens=False)
        b = LIBRARY.encode(text or "")
        shown = [bytes([int(LIBRARY.id_to_piece(i)[3:5], 16)]) if LIBRARY.is_byte(i)
                 else LIBRARY.id_to_piece(i).replace("▁", " ").encode() for i in b]
        spelled = decode.decode(a.tokens)
        if text and spelled == " " + text and b"".join(shown) == data:
            ends, cover = [], []
            for ids, sizes in ((a.ids, [len(bytes(map(BYTE_OF.get, t))) for t in a.tokens]), (b, map(len, shown))):
                at, own_ends, own_cover = 0, [], []
                for n, size in enumerate(sizes):
                    own_cover += [n] * size
                    own_ends.append(at := at + size)
                ends.append(own_ends)
                cover.append(own_cover)
            own = sorted(set(zip(*cover)))
            shared = sorted(set(ends[0]) & set(ends[1]))
            group = dict(zip(shared, range(len(shared))))
            parts = [([], []) for _ in shared]
            for side, ids in enumerate((a.ids, b)):
                now = 0
                for i, end in zip(ids, ends[side]):
                    parts[now][side].append(str(i))
                    now += end in group
            links.append((len(a.ids), len(b), [(a.ids[x], b[y]) for x, y in own], ";".join("|".join(map(",".join, p)) for p in parts), len(shared)))
        else:
            links.append((0, 0, [], "", 0))
    count = Counter(p for x in links for p in set(x[2]))
    most = {}
    for (a, _), n in count.items():
        most[a] = max(n, most.get(a, 0))
    return sorted(((d, na, nb, ng, len(own), sum(count[p] == most[p[0]] for p in own), sum(count[p] for p in own),
                    sha(told) if told else "") for (d, _), (na, nb, own, told, ng) in zip(docs, links)), key=str)


def flat(df):
    return sorted((tuple(r) for r in df.select("doc_id", *[f"aligned.{c}" for c in (
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")]).collect()), key=str)


def test_align_strange(spark):
    docs = list(enumerate([*STRANGE, *STRANGE[5:12], "the cat sat", "the cat", "the  cat\tsat\n"])) + [(None, "the cat"), (None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    own = token_align.aligned(df, BYTE_LEVEL, public_tokenizers.PATTERN, MODEL, groups=True)
    assert flat(own) == brute_align(docs)
    for r in own.collect():
        assert sha(r.aligned.groups) == r.aligned.groups_sha256 or r.aligned.groups == r.aligned.groups_sha256 == ""


def test_align_odd(spark, odd, empty):
    names = {n: F.lit("clash") for n in ("key", "n", "row", "chunk", "n_a", "n_best", "m", "pair")}
    own = token_align.aligned(odd.withColumns(names), BYTE_LEVEL, public_tokenizers.PATTERN, MODEL)
    assert flat(own) == brute_align([(r.doc_id, r.text) for r in odd.collect()])
    assert own.where("key = 'clash' and `row` = 'clash' and n_a = 'clash' and aligned.groups is null").count() == odd.count()
    assert token_align.aligned(empty, BYTE_LEVEL, public_tokenizers.PATTERN, MODEL).count() == 0


def test_byte_level_is_the_rank_file():
    from tickwise.llm import byte_bpe
    assert token_align.load_byte_level(BYTE_LEVEL) == byte_bpe.load_ranks(queries.rank_file())


def test_align_query(spark, sf, documents):
    own = queries.QUERIES["op13_token_align"](spark, sf).collect()
    assert sorted(map(tuple, own), key=str) == brute_align([d[:2] for d in documents])

"""Odd rows, empty tables, and the parts of the operators against brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import regex
import tiktoken
from helpers import components, repeats, simhash
from pyspark.sql import functions as F

from tickwise.llm import (byte_bpe, decontaminate, fingerprint, language, line_dedup, queries,
                          sharding, simhash as sh, suffix_dedup, toxicity, url_filter)
from tickwise.llm.common import held_out
from tickwise.session import materialize

RANKS = byte_bpe.load_ranks(queries.rank_file())


# --- odd rows and empty tables -------------------------------------------------

def test_simhash_odd(spark, odd, empty):
    found = sh.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    of = {r.doc_id: r for r in found if r.doc_id is not None}
    assert of[1].fp == of[2].fp == of[3].fp == 0 and {of[i].component_id for i in (1, 2, 3)} == {1}
    assert of[5].component_id == of[8].component_id == 5
    assert {r.component_id for r in found if r.doc_id is None} == {5, 1}
    kept = sh.one_of_each(odd, sh.near_duplicates(odd)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id) == sorted({of[i].component_id for i in of})
    assert all(r.hits == "clash" for r in kept)
    assert sh.near_duplicates(empty).count() == 0


def test_simhash_repeated_ids(spark):
    """Unlike texts under one id are told apart, and so are their neighbours."""
    rng = random.Random(8)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60))
    a, b, c = text(), text(), text()
    docs = [(1, a), (1, b), (2, a), (3, b), (4, c), (4, a), (4, c), (5, c), (None, text())]
    assert min((simhash(x) ^ simhash(y)).bit_count() for x, y in ((a, b), (a, c), (b, c))) > 3
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = sh.near_duplicates(df)
    own = {(r.doc_id, r.fp % 2 ** 64): r for r in found.collect()}
    assert own[2, simhash(a)].root != own[3, simhash(b)].root
    assert {k: r.component_id for k, r in own.items() if k[0]} == {
        (i, simhash(t)): {a: 1, b: 1, c: 4}[t] for i, t in docs if i}
    kept = sorted(tuple(r) for r in sh.one_of_each(df, found).collect() if r.doc_id)
    assert kept == sorted([(1, a), (1, b), (4, c)])
    assert sh.one_of_each(df, found).where("doc_id is null").count() == 1


def test_decontaminate_odd(spark, odd, empty):
    bench = spark.createDataFrame([(9, "one two"), (10, "one two"), (11, None), (12, ""), (None, "word"), (13, "word word")],
                                  "item_id long, text string")
    found = {r.doc_id: r.hits for r in decontaminate.benchmark_hits(odd, bench).collect() if r.doc_id}
    assert found[1].n_words == found[2].n_words == found[3].n_words == 0
    assert found[5]["items"] == ["10", "9"] and [tuple(s) for s in found[5].spans] == [(0, 2)]
    assert found[6].n_words == 30_000 and [tuple(s) for s in found[6].spans] == [(0, 30_000)]
    assert decontaminate.benchmark_hits(empty, bench).count() == 0
    assert decontaminate.benchmark_hits(odd, bench.limit(0)).where("size(hits.items) > 0").count() == 0


def test_decontaminate_item_without_id(spark):
    bench = spark.createDataFrame([(None, "red fox"), (None, "red fox"), (7, "blue"), (8, "red fox"), (None, None), (None, "two owls")],
                                  "item_id long, text string")
    df = spark.createDataFrame([(1, "a red fox"), (2, "two owls blue"), (3, "two owls"), (4, "owls")], "doc_id long, text string")
    found = {r.doc_id: r for r in decontaminate.benchmark_hits(df, bench).withColumn("bad", decontaminate.contaminated()).collect()}
    assert {i: [tuple(s) for s in r.hits.spans] for i, r in found.items()} == {1: [(1, 3)], 2: [(0, 3)], 3: [(0, 2)], 4: []}
    assert {i: r.hits["items"] for i, r in found.items()} == {1: ["8"], 2: ["7"], 3: [], 4: []}
    assert {i for i, r in found.items() if r.bad} == {1, 2, 3}


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (5, 1), (5, 1), (6, 0), (8, None), (None, 1), (77, 1)], "doc_id long, toxic int")
    members = toxicity.train(odd, labels)
    scored = toxicity.with_score(odd, members).collect()
    assert len(scored) == odd.count() and all(0 <= r.toxicity <= 1 for r in scored)
    assert len({r.toxicity for r in scored if r.text in (None, "", " \t\n", "12345 !!")}) == 1
    assert toxicity.train(odd, labels.limit(0)) == [] and toxicity.train(empty, labels) == []
    assert {r.toxicity for r in toxicity.with_score(odd, []).collect()} == {0.0}
    assert toxicity.with_score(empty, members).count() == 0


def test_url_filter_odd(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://Example.ORG/es/x", "http://a.b.example.org/en/15?q#f",
            "http://badexample.org/es/", "http://x.com/fr/1", "http://x.com", "http://x.com?/fr/", "http://x.com/de/#a",
            "a://b://c/d", "http://org/", "http://u@example.org:80/es/", "http://example.org/es/"]
    pages = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(urls)], "page_id long, url string, judged string")
    found = [tuple(r.judged) for r in url_filter.judge_urls(pages, queries.URL_RULES).orderBy("page_id").collect()]
    assert found == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("example.org", "/es/x", "example.org/es/", "block"), ("a.b.example.org", "/en/15", "example.org/en/1", "block"),
        ("badexample.org", "/es/", "org/", "allow"), ("x.com", "/fr/1", "com/fr/", "allow"), ("x.com", "", None, "allow"),
        ("x.com", "", None, "allow"), ("x.com", "/de/", "com/de/", "block"), ("b:", "//c/d", None, "allow"),
        ("org", "/", "org/", "allow"), ("u@example.org:80", "/es/", None, "allow"), ("example.org", "/es/", "example.org/es/", "block")]
    assert url_filter.judge_urls(pages, []).where("judged.verdict <> 'allow'").count() == 0
    assert url_filter.judge_urls(pages.limit(0), queries.URL_RULES).count() == 0


def test_digest_collision_is_no_hit(monkeypatch):
    """Equal digests of unlike rules are told apart by the stored text."""
    monkeypatch.setattr(url_filter, "digest", lambda key: 7)
    array = url_filter.DigestArray(url_filter.pack([("a.org", "/", "block"), ("b.org", "/", "allow"), ("b.org", "/x", "block")]))
    judged = array.judge(["http://b.org/x", "http://b.org/y", "http://c.org/", "http://a.org/"], "none")
    assert [r["verdict"] for r in judged] == ["block", "allow", "none", "block"]


def test_line_dedup_odd(spark, odd, empty):
    docs = [(i, "s", f"own {i}\n  menu\t\n\nmenu\n") for i in range(30)] + [(99, None, "menu"), (98, "t", "menu"), (97, "s", None), (96, "s", "")]
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, source string, text string, deduped string")
    found = {r.doc_id: r.deduped for r in line_dedup.drop_boilerplate(df).collect()}
    assert found[3].text == "own 3\n\n" and (found[3].n_lines, found[3].n_dropped) == (5, 2)
    assert found[99].text == found[98].text == "menu"
    assert found[97].text is None and found[97].n_lines == 0 and found[96].text == "" and found[96].n_lines == 1
    cut = line_dedup.drop_boilerplate(odd).where("deduped.n_dropped > 0").collect()  # four of the eleven rows say "one two"
    assert [(r.text, r.deduped.text) for r in cut] == [("one two", "")] * 4 and all(r.fp == "clash" for r in cut)
    assert line_dedup.drop_boilerplate(empty).count() == 0


def test_line_dedup_small_hosts(spark):
    """The ratio judges hosts of every size: 19 pages as 20, and two like ones."""
    docs, names = [], ["__lines", "__all", "__kept", "row", "host"]
    for pages, held in ((1, 1), (2, 1), (2, 2), (9, 1), (9, 2), (10, 1), (19, 1), (19, 2), (20, 2), (21, 3), (60, 6), (60, 7)):
        docs += [(f"{pages}/{held}", f"own {pages} {held} {k}" + "\nmenu" * (k < held) * 2, *["x"] * len(names)) for k in range(pages)]
    docs += [("long", "word " * 30_000 + "\nfoot", *["x"] * len(names))] * 2
    df = spark.createDataFrame(docs, "source string, text string, " + ", ".join(f"`{n}` string" for n in names))
    found = line_dedup.drop_boilerplate(df).collect()
    assert all(r[n] == "x" for r in found for n in names) and len(found) == len(docs)
    cut = {r.source for r in found if r.deduped.n_dropped}
    assert cut == {"2/2", "9/2", "19/2", "21/3", "60/7", "long"}
    assert all(("menu" in r.deduped.text) == ("menu" in r.text) for r in found if r.source not in cut)
    assert {r.deduped.text for r in found if r.source == "long"} == {""}


def test_decontaminate_in_parts(spark, odd):
    """A benchmark in many parts gives what one pass gives, with clashing names too."""
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 2)
    items = [(i, " ".join(word() for _ in range(rng.choice((1, 2, 13, 20))))) for i in range(40)] + [(None, "one"), (77, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(i, " ".join(word() for _ in range(300))) for i in range(100, 140)], "doc_id long, text string"))
    docs = docs.withColumns({"row": F.lit("x"), "part_0": F.lit("y")})
    one, many = (sorted(map(str, decontaminate.benchmark_hits(docs, bench, part_bytes=n).collect())) for n in (1 << 20, 250))
    assert one == many and any("items=['" in x for x in one)


def test_url_rules_in_parts(spark):
    rng = random.Random(4)
    host = lambda: ".".join(rng.choice(["a", "bb", "c"]) for _ in range(rng.randint(1, 3)))
    path = lambda: "/" + "/".join(rng.choice("xyz") for _ in range(rng.randint(0, 2)))
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((host(), path()) for _ in range(150))}.values())
    urls = [f"http://{host()}{path()}" for _ in range(500)] + [None, "", "x", "http://" + "a." * 3000 + "bb/" + "x/" * 3000] + ["http://a/x"] * 3
    df = spark.createDataFrame([(u, "z") for u in urls], "url string, row string")
    one, many = (sorted(map(str, url_filter.judge_urls(df, rules, part_bytes=n).collect())) for n in (1 << 20, 300))
    assert one == many and any("rule='" in x for x in one)


def test_million_url_rules():
    """Rules of many hosts: each is found, and its neighbours aren't."""
    rules = [(f"h{i}.org", f"/{i % 7}", "block" if i % 3 else "allow") for i in range(1_000_000)]
    array = url_filter.DigestArray(url_filter.pack(rules))
    found = array.judge([f"https://www.h{i}.org/{i % 7 + k}/x" for i in range(0, 1_000_000, 40_001) for k in (0, 10)], "allow")
    assert [f["rule"] for f in found[::2]] == [f"h{i}.org/{i % 7}" for i in range(0, 1_000_000, 40_001)]
    assert [f["verdict"] for f in found[::2]] == ["block" if i % 3 else "allow" for i in range(0, 1_000_000, 40_001)]


def test_byte_bpe_odd(spark, odd, empty):
    coded = byte_bpe.encode_decode(odd, queries.rank_file(), public_tokenizers.PATTERN).collect()
    assert all(bytes(r.bpe.decoded).decode() == (r.text or "") for r in coded) and len(coded) == odd.count()
    assert all((len(r.bpe.ids) == 0) == (not r.text) and r.fp == "clash" for r in coded)
    assert byte_bpe.encode_decode(empty, queries.rank_file(), public_tokenizers.PATTERN).count() == 0


def test_language_odd(spark, odd, empty):
    model = language.train(odd)
    found = {r.doc_id: r.guess for r in language.with_language(odd, model).collect() if r.doc_id}
    assert {i: found[i].lang for i in found} == {1: "und", 2: "und", 3: "und", 4: "und", 5: "en", 6: "en", 7: "en", 8: "en"}
    assert language.train(empty) is None and language.train(odd.withColumn("lang", F.lit(None).cast("string"))) is None
    assert language.with_language(odd, None).select("guess.lang").distinct().collect()[0][0] == "und"


def test_suffix_dedup_odd(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.where("doc_id is null or doc_id not in (6, 7)").collect()]
    rows += [(6, "word " * 300), (7, "x" * 1_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.without_repeats(df).select("doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.sha2("cut.kept", 256))
    assert sorted(map(tuple, found.collect()), key=str) == repeats(rows, 400)
    assert suffix_dedup.without_repeats(odd).where("doc_id in (6, 7) and cut.n_removed < cut.n_bytes").count() == 0
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_fingerprint_odd(spark, odd, empty):
    docs = odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "next")
    found = fingerprint.with_next(docs, "doc_id", ["text"]).collect()
    ids = [r.doc_id for r in found]
    assert len(found) == len(docs.collect()) and ids.count(8) == 2
    follow = {r.doc_id: r.next.text for r in found if r.doc_id in (4, 5, 6)}
    assert follow == {4: " \t\n", 5: "12345 !!", 6: "one two"}
    sketched = {r.doc_id: r.sketch for r in fingerprint.with_sketch(odd, "text", "sketch").collect()}
    assert sketched[1] == sketched[2] == sketched[3] == ([], None) and sketched[5].least is not None
    clash = odd.select("*", *[F.lit("own").alias(c) for c in ("__words", "__hashes", "__key", "__bucket", "__guest", "__host", "a.b")])
    found = fingerprint.with_next(fingerprint.with_sketch(clash, "text", "sketch"), "doc_id", ["sketch"]).collect()
    assert len(found) == odd.count() and all({r["__words"], r["__hashes"], r["__key"], r["__bucket"], r["__guest"], r["__host"]} == {"own"}
                                             and r.fp == "clash" for r in found)
    assert all(r.sketch == sketched[r.doc_id] for r in found if r.doc_id is not None)  # two texts have no id
    assert fingerprint.with_next(empty.select("doc_id", "text"), "doc_id", ["text"]).count() == 0
    one = spark.createDataFrame([(5, "alone")], "doc_id long, text string")
    assert fingerprint.with_next(one, "doc_id", ["text"]).first().next.text == "alone"


def test_sharding_odd(spark, odd, empty):
    rows = odd.select("doc_id", F.coalesce(F.octet_length("text") + 1, F.lit(1)).alias("size"), "text")
    found = sharding.shard_groups(rows, "text", "size", shards=3).collect()
    assert len(found) == rows.count()
    shards = {}
    for r in found:
        shards.setdefault(r.text, set()).add(r.shard)
    assert all(len(s) == 1 for s in shards.values())
    for k in range(3):
        slots = sorted(r.slot for r in found if r.shard == k)
        assert slots == list(range(len(slots)))
    assert sharding.shard_groups(rows.limit(0), "text", "size").count() == 0
    clash = rows.select("*", *[F.lit("own").alias(c) for c in ("__group", "__part", "__own", "__at", "__n", "__sum", "__same", "a.b")],
                        F.lit(-1).alias("slot"), F.col("text").alias("shard"))
    again = sharding.shard_groups(clash, "shard", "size", shards=3).collect()
    key = lambda r: (r.text or "", r.shard, r.size)
    assert sorted(map(key, again)) == sorted(map(key, found)) and {r["a.b"] for r in again} == {r["__part"] for r in again} == {"own"}
    assert sorted((r.shard, r.slot) for r in again) == sorted((r.shard, r.slot) for r in found)


# --- the parts -----------------------------------------------------------------

def test_trie_join_at_every_split(spark):
    """Clusters of near fingerprints, with node pairs split down to single ones."""
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(100)}
    for centre in [rng.getrandbits(64) for _ in range(3)]:
        for _ in range(80):
            value = centre
            for _ in range(rng.randint(0, 6)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    rows = [(i, v - (v >> 63 << 64)) for i, v in enumerate(sorted(values))]
    fps = spark.createDataFrame(rows, "id long, fp long")
    expected = components([(i, v % 2 ** 64) for i, v in rows])
    for task_rows in (1024, 8):
        found = {r.id: r.root for r in sh.components(materialize(sh.links(fps, task_rows=task_rows))).collect()}
        assert {i: found.get(i, i) for i, _ in rows} == expected


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1_000, 1_000 + i) for i in range(1, 300)]
    found = {r.id: r.root for r in sh.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(found.values()) == {0, 1_000} and len(found) == 100 + 299


def test_fingerprint_of_many_words():
    text = " ".join(f"w{i % 70_001}" for i in range(70_100))
    assert sh.fingerprint(text) % 2 ** 64 == simhash(text)


def test_merge_replay_is_the_library():
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    rng = random.Random(3)
    texts = ["a" * 5_000, " " * 900, "ab" * 999, "é" * 77, "".join(rng.choice("aeiotrns ") for _ in range(9_000)),
             "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x4E00, 0x9FFF), rng.randrange(0x1F300, 0x1F700)]))
                     for _ in range(4_000))]
    pieces = [p.encode() for t in texts for p in regex.findall(public_tokenizers.PATTERN, t)]
    replay = byte_bpe.MergeReplay(RANKS)
    for piece, ids in zip(pieces, replay.encode(pieces)):
        assert ids == library._core_bpe.encode_single_piece(piece) and replay.decode(ids) == piece
    assert replay.encode([b"", b"a"]) == [[], [RANKS[b"a"]]] and replay.encode([]) == []


def test_merge_replay_takes_a_lower_rank_first():
    """A merge that opens a pair of lower rank lets it go first, as the library does."""
    ranks = {bytes([b]): 1_000 + b for b in range(256)} | {b"ab": 10, b"aba": 5, b"abaab": 3}
    library = tiktoken.Encoding("own", pat_str=r"[a-z]+", mergeable_ranks=ranks, special_tokens={})
    replay = byte_bpe.MergeReplay(ranks)
    rng = random.Random(1)
    for _ in range(300):
        piece = "".join(rng.choice("ab") for _ in range(rng.randint(1, 14))).encode()
        assert replay.encode([piece])[0] == library._core_bpe.encode_single_piece(piece)


def test_wu_manber_is_plain_search():
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice(["a", "b", "c1", "é"]) for _ in range(n))
    items = [(str(k), text(rng.choice([1, 2, 3, 5, 13, 16, 30]))) for k in range(12)] + [("x", ""), ("y", None)]
    searches = decontaminate.tables(items)
    for _ in range(60):
        words = text(rng.randint(0, 60)).split()
        words += decontaminate.words_of(rng.choice(items)[1])  # str and bytes meet below
        words = [w.encode() if isinstance(w, str) else w for w in words] + decontaminate.words_of(text(5))
        hit, found = set(), set()
        for item, t in items:
            own = decontaminate.words_of(t)
            m = min(13, len(own))
            for k in range(len(own) - m + 1 if own else 0):
                for at in range(len(words) - m + 1):
                    if words[at:at + m] == own[k:k + m]:
                        hit |= set(range(at, at + m))
                        found.add(item)
        got = decontaminate.find(searches, b" ".join(words).decode())
        assert {w for s in got["spans"] for w in range(s["start"], s["end"])} == hit
        assert got["items"] == sorted(found) and got["n_words"] == len(words)


def test_lpt_deals_as_the_heap_does():
    rng = random.Random(4)
    for _ in range(50):
        sizes = [rng.choice([1, 2, 3, 5, 50, 400]) for _ in range(rng.randint(1, 120))]
        loads = [0] * 5
        for s in sorted(sizes, reverse=True):
            loads[loads.index(min(loads))] += s
        own = [0] * 5
        for size, ends in sharding.deal([(s, s, sizes.count(s)) for s in set(sizes)], 5):
            assert ends[-1] == sizes.count(size)
            for j, n in enumerate(np.diff([0, *ends])):
                own[j] += size * int(n)
        assert sorted(own) == sorted(loads)


def test_size_classes(spark):
    sizes = [1, 1000, 65_536, 65_537, 70_001, 10 ** 9 + 7, 2 ** 40 + 1]
    found = [r[0] for r in spark.createDataFrame([(s,) for s in sizes], "s long").select(sharding.size_class(F.col("s"))).collect()]
    assert found[:3] == sizes[:3] and all(c <= s < c * 1.001 for s, c in zip(sizes, found))


def test_next_follows_any_ids(spark):
    rng = random.Random(6)
    ids = list({rng.choice([rng.randrange(50), rng.randrange(-10 ** 6, 10 ** 6), rng.randrange(-2 ** 62, 2 ** 62)]) for _ in range(300)})
    df = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id long, text string")
    found = {r.doc_id: int(r.next.text) for r in fingerprint.with_next(df, "doc_id", ["text"]).collect()}
    order = sorted(ids, reverse=True)
    assert found == dict(zip(order, order[1:] + order[:1]))


def test_sketches_merge_and_contain(spark):
    words = [f"w{i}" for i in range(3_000)]
    row = [(" ".join(words[:1_000]), " ".join(words[1_000:]), " ".join(words))]
    df = spark.createDataFrame(row, "a string, b string, whole string")
    for c in "a", "b", "whole":
        df = fingerprint.with_sketch(df, c, f"s_{c}")
    got = df.select(fingerprint.containment("s_a", "s_whole").alias("c"), fingerprint.likeness("s_a", "s_whole").alias("l"),
                    F.size(F.array_except(fingerprint.merged("s_a", "s_b")["hashes"], "s_whole.hashes")).alias("rest")).first()
    assert got.c == 1 and abs(got.l - 1 / 3) < 0.1 and got.rest == 0


def test_sketches_of_short_texts(spark):
    """Of a text wholly inside another one the containment is 1 or, where its sketch
    is empty, unknown; merged sketches are the sketch of the joined text."""
    texts = [" ".join(f"w{i}x{j}" for j in range(7)) for i in range(300)]
    rows = [(t.rsplit(" ", 2)[0], t.split(" ", 1)[1], t.rsplit(" ", 1)[0], t) for t in texts]
    df = spark.createDataFrame(rows, "five string, rest string, six string, seven string")
    for c in df.columns:
        df = fingerprint.with_sketch(df, c, f"s_{c}")
    got = df.select("s_five.hashes", fingerprint.containment("s_five", "s_six").alias("c"),
                    fingerprint.merged("s_five", "s_rest").alias("m"), F.col("s_seven").alias("whole"),
                    fingerprint.likeness("s_five", "s_five").alias("one")).collect()
    assert {r.c for r in got} == {None, 1.0} and all((r.c is None) == (not r.hashes) and r.one == 1 for r in got)
    assert 15 < sum(r.c == 1 for r in got) < 65  # about one in eight
    assert all(r.m == r.whole for r in got)


def test_suffix_dedup_with_crowded_cores(spark):
    """Shared passages in many surroundings, with cores settled by order and by count."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [text(rng.randint(5, 40)) for _ in range(8)]
    docs = []
    for i in range(70):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts.append(rng.choice(passages) if rng.random() < .5 else text(rng.randint(1, 30)))
            p, a = rng.choice(passages), rng.randrange(20)
            parts.append(p[a:a + rng.randint(1, 200)])
        docs.append((i, " ".join(parts)))
    docs += [(500, "a" * 200), (501, "ab" * 90), (502, docs[3][1]), (502, docs[3][1]), (None, docs[4][1]), (503, "aaab" * 60 + "c" + "aaab" * 60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for length, spread, task_rows in ((40, 20, 2_000), (60, 28, 2)):
        found = suffix_dedup.without_repeats(df, length=length, spread=spread, task_rows=task_rows).select(
            "doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.sha2("cut.kept", 256))
        assert sorted(map(tuple, found.collect()), key=str) == repeats(docs, length)


def test_pu_learning_finds_the_stems():
    """Toxic texts are told from clean ones though no clean one is labelled."""
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    def made(toxic):
        words = [word() for _ in range(40)]
        if toxic:
            words[:3] = [f"zork{word()}" for _ in range(3)]
        found = [f for w in sorted(set(words)) for f in toxicity.word_features(w)]
        return np.array(found, np.int32), len(set(words))
    positive = [made(True) for _ in range(150)]
    unlabelled = [made(k % 10 == 0) for k in range(1_500)]
    weights, offset = toxicity.fit(positive, unlabelled, 0.1, 0)
    score = lambda rows: toxicity.sigmoid(toxicity.Packed(rows).logits(weights, offset))
    assert (score([made(True) for _ in range(100)]) >= 0.3).mean() > 0.9
    assert (score([made(False) for _ in range(100)]) >= 0.3).mean() < 0.1


def test_language_is_exact_kernel_ridge(spark, documents):
    """Against the unhashed kernel with every training row as a landmark, solved in one piece."""
    docs = [(i, t[:300], lang) for i, t, lang, _ in documents if t and lang]
    learnt = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 4 != 2]
    names = sorted({d[2] for d in learnt})
    grams = lambda t: {t[k:k + n] for t in [t.lower().encode()] for n in (1, 2, 3) for k in range(len(t) - n + 1)}
    sets = {i: grams(t) for i, t, _ in docs}
    exact = lambda a, b: np.array([[len(sets[x] & sets[y]) / (len(sets[x]) * len(sets[y])) ** .5 for y in b] for x in a])
    own, every = [d[0] for d in learnt], [d[0] for d in docs]
    values, vectors = np.linalg.eigh(exact(own, own))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    mapped, target = exact(own, own) @ root, np.array([[1.0 if d[2] == n else -1.0 for n in names] for d in learnt])
    weight = np.array([[1 / sum(e[2] == d[2] for e in learnt)] for d in learnt])
    solved = np.linalg.solve(mapped.T @ (weight * mapped) + language.RIDGE * np.eye(len(own)), mapped.T @ (weight * target))
    best = dict(zip(every, (exact(every, own) @ root @ solved).argmax(axis=1)))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(7)
    found = {r.doc_id: r.guess.lang for r in language.with_language(df, language.train(df)).collect()}
    assert sum(found[i] == names[best[i]] for i in every) >= 0.98 * len(every)


def test_language_sums_are_one_solve():
    """Rows added up by tasks solve the same regressions as all rows together."""
    rng = np.random.default_rng(3)
    x = (rng.random((500, sum(language.PLACES))) < 0.01).astype(np.float32)
    y = rng.integers(0, 3, 500)
    sizes, root = np.bincount(y).astype(float), language.nystrom(x[:40])
    whole = language.normal_equations(x, y, sizes, x[:40], root)
    parts = [language.normal_equations(x[a:a + 77], y[a:a + 77], sizes, x[:40], root) for a in range(0, 500, 77)]
    assert all(np.allclose(sum(p[k] for p in parts), whole[k]) for k in (0, 1))


def test_language_learns_equal_rows_once(spark):
    """Copies without an id, however many, are one training row."""
    rows = [(None, "same words", "en")] * 5_000 + [(i, f"autre texte {i}", "fr") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, packed, _ = language.train(df)
    assert names == ["en", "fr"] and len(packed) == sum(language.PLACES) // 8 * (1 + sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(20)))


def test_held_out_is_a_quarter(spark):
    from helpers import held_out as plain
    rows = spark.range(400).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == plain(r.id) for r in rows) and 60 < sum(r.h for r in rows) < 140
    assert spark.sql("SELECT cast(null AS bigint) AS id").select(held_out("id")).first()[0] is False


def test_long_texts_in_segments(spark, monkeypatch):
    """Texts cut into segments give what they give in one piece."""
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh é\n") for _ in range(6_000))
    docs = [(1, text), (2, text[1_000:4_000] + "z" + text[500:2_500])]
    one, two = (np.zeros(sum(language.PLACES), np.float32) for _ in range(2))
    language.presence(text, one)
    monkeypatch.setattr(language, "SEGMENT", 700)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 333)
    monkeypatch.setattr(sh, "COUNTED", 50)
    language.presence(text, two)
    assert (one == two).all() and sh.fingerprint(text) % 2 ** 64 == simhash(text)
    found = suffix_dedup.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).select(
        "doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.sha2("cut.kept", 256))
    assert sorted(map(tuple, found.collect()), key=str) == repeats(docs, 400)

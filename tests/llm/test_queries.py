"""Every registered query on the smallest tables, against SQL or brute force."""

import hashlib
import re

import duckdb
import pandas as pd
import pytest
import public_tokenizers
import tiktoken
import xxhash
from pyspark.sql import functions as F
from helpers import components, held_out, repeats, simhash

import corpus_pipeline
from tickwise.llm import byte_bpe, decontaminate, queries


def rows(spark, sf, name):
    return queries.QUERIES[name](spark, sf).toPandas()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    own, sql = rows(spark, sf, name), con.sql(queries.ORACLE_SQL[name]).df()
    key = [*own.columns[:2]]
    own, sql = (x[sorted(x.columns)].sort_values(key).reset_index(drop=True) for x in (own, sql))
    pd.testing.assert_frame_equal(own, sql, check_dtype=False)


def test_simhash(spark, sf, documents):
    own = rows(spark, sf, "op1_simhash").set_index("doc_id")
    pairs = [(i, simhash(t)) for i, t, *_ in documents]
    assert {i: int(f, 16) for i, f in own.fingerprint.items()} == dict(pairs)
    assert own.component_id.to_dict() == components(pairs)


def test_byte_bpe(spark, sf, documents):
    own = rows(spark, sf, "op6_byte_bpe").set_index("doc_id")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=byte_bpe.load_ranks(queries.rank_file()))
    for i, text, *_ in documents:
        ids = library.encode_ordinary(text or "")
        assert own.n_tokens[i] == len(ids)
        assert own.ids_sha256[i] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert own.decoded_sha256[i] == hashlib.sha256((text or "").encode()).hexdigest()


def test_suffix_dedup(spark, sf, documents):
    own = sorted(map(tuple, rows(spark, sf, "op8_suffix_dedup").values.tolist()), key=str)
    assert own == repeats([d[:2] for d in documents], 400)


def test_fingerprint(spark, sf, documents):
    own = rows(spark, sf, "op9_fingerprint").set_index("doc_id")
    texts = {i: t or "" for i, t, *_ in documents}
    order = sorted(texts, reverse=True)
    shingles = lambda t: {tuple(t.split()[k:k + 5]) for k in range(max(1, len(t.split()) - 4))}
    off = []
    for i, j in zip(order, order[1:] + order[:1]):
        text, half = texts[i], len(texts[i]) // 2
        edited = text[:len(text) - half] + texts[j][:half]
        assert own.n_chars[i] == len(text)
        assert own.edited_sha256[i] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingles(text), shingles(edited)
        off.append(abs(own.near_edited[i] - len(a & b) / len(a | b)))
        assert (own.fingerprint[i] == own.edited_fingerprint[i]) or text != edited
        if text == texts[j]:
            assert own.near_next[i] == 1 and own.fingerprint[i] == own.fingerprint[j]
    assert sum(off) / len(off) < 0.12


def test_sharding(spark, sf, documents):
    own = rows(spark, sf, "op10_sharding").set_index("doc_id")
    texts = {i: (t or "").encode() for i, t, *_ in documents}
    assert len(own) == len(texts) and set(own.law) == {"bytes"}
    assert own["size"].to_dict() == {i: len(t) + 1 for i, t in texts.items()}
    shard_of = {}
    for i, t in texts.items():
        assert shard_of.setdefault(t, own.shard[i]) == own.shard[i]
    for _, part in own.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    loads, groups = own.groupby("shard")["size"].sum(), {}
    for i, t in texts.items():
        groups[t] = groups.get(t, 0) + len(t) + 1
    assert sorted(own.shard.unique()) == list(range(8))
    assert loads.max() - loads.min() <= max(groups.values())


def test_toxicity(spark, sf, documents):
    own = rows(spark, sf, "op3_toxicity").set_index("doc_id")
    assert len(own) == len(documents) and own.score.between(0, 1).all()
    assert (own.predicted == (own.score >= 0.3)).all()
    assert own.held_out.to_dict() == {i: held_out(i) for i, *_ in documents}


def test_toxicity_held_out(spark):
    """Held-out labels of a table with a few hundred toxic examples."""
    big = "/root/testdata/sf0.1"
    own = rows(spark, big, "op3_toxicity").set_index("doc_id")
    labels = spark.read.parquet(f"{big}/labels.parquet").select("doc_id", "toxic").toPandas().set_index("doc_id").toxic
    both = own[own.held_out].join(labels, how="inner")
    hit = ((both.predicted == 1) & (both.toxic == 1)).sum()
    assert hit / (both.predicted == 1).sum() >= 0.85 and hit / (both.toxic == 1).sum() >= 0.8


def test_fingerprint_is_brute_force_sketch(spark, sf, documents):
    """The shown sketches against hashes chained word by word in Python."""
    own = rows(spark, sf, "op9_fingerprint").set_index("doc_id").fingerprint
    for i, text, *_ in documents:
        words, found = [w for w in re.split(r"[ \t\n\x0b\f\r]+", (text or "").lower()) if w], set()
        for k in range(len(words) - 4):
            h = 42
            for w in words[k:k + 5]:
                h = xxhash.xxh64_intdigest(w.encode(), h)
            found.add(h - (h >> 63 << 64))
        if 0 < len(words) < 5:
            h = xxhash.xxh64_intdigest(" ".join(words).encode(), 42)
            found.add(h - (h >> 63 << 64))
        kept = sorted(h for h in found if h < -(1 << 63) + (1 << 61)) or sorted(found)[:1]
        assert own[i] == ",".join(f"{h % 2 ** 64:016x}" for h in kept)


def test_language(spark, sf, documents):
    own = rows(spark, sf, "op7_language").set_index("doc_id")
    right = [own.lang_pred[i] == lang for i, _, lang, _ in documents if held_out(i)]
    assert own.score.between(0, 1).all() and sum(right) / len(right) > 0.95


def test_pipeline(spark, sf):
    """Each stage against a brute-force version over what the stage before kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "decontaminate", "byte_bpe"]
    results = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf))
        results.append({r.doc_id: r for r in docs.collect()})
    toxic, lines, single, clean, coded = results
    assert set(toxic) <= set(kept) and all(toxic[i] == kept[i] for i in toxic)
    assert set(lines) == set(toxic)
    assert all(set(lines[i].text.split("\n")) <= set(toxic[i].text.split("\n"))
               and lines[i].n_chars == len(lines[i].text) for i in lines)
    groups = components([(i, simhash(r.text)) for i, r in lines.items()])
    assert set(single) == set(groups.values()) and all(single[i] == lines[i] for i in single)
    bench = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams = {tuple(w[k:k + 13]) for _, t in bench for w in [decontaminate.words_of(t)]
             for k in range(max(1, len(w) - 12)) if w}
    for i, r in single.items():
        words, hit = decontaminate.words_of(r.text), set()
        for m in {len(g) for g in grams}:
            for k in range(len(words) - m + 1):
                if tuple(words[k:k + m]) in grams:
                    hit |= set(range(k, k + m))
        assert (i in clean) != (bool(hit) and 20 * len(hit) >= len(words))
    assert all(list(r.asDict()) == columns for part in results[:4] for r in part.values())
    assert set(coded) == set(clean)
    assert all(coded[i].decoded_sha256 == hashlib.sha256(clean[i].text.encode()).hexdigest() for i in coded)
    assert corpus_pipeline.run(spark, sf).count() == len(coded)


def test_pipeline_cuts_lines_of_small_sources(spark, sf):
    """Sources of under 20 pages lose their boilerplate too."""
    docs = []
    for pages, held in ((1, 1), (2, 2), (9, 2), (10, 7), (19, 2), (20, 2), (60, 6), (60, 7)):
        docs += [(len(docs) + k, f"{pages}/{held}", f"own {pages} {held} {k}" + "\nmenu" * (k < held), 0) for k in range(pages)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string, n_chars long")
    found = corpus_pipeline.drop_boilerplate_lines(spark, df, sf).collect()
    assert len(found) == len(docs) and all(r.n_chars == len(r.text) for r in found)
    left = {r.source for r in found if "menu" in r.text}
    assert left == {"1/1", "20/2", "60/6"}
    assert all(r.text.startswith("own ") for r in found)


def test_pipeline_keeps_one_of_like_pages(spark, sf):
    """Pages that a source holds twice are left to the stage that keeps one of them."""
    page = "\n".join(f"line {k} of a page that its source holds twice" for k in range(20))
    docs = [(1, page), (2, page), (3, "menu"), (4, "menu"), (5, "menu\n\n \t"), (6, "menu\nown text"), (7, ""), (8, None)]
    docs = [(i, "s", t, None if t is None else len(t)) for i, t in docs]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string, n_chars long")
    lines = corpus_pipeline.drop_boilerplate_lines(spark, df, sf)
    found = {r.doc_id: r for r in lines.collect()}
    assert {i: r.text for i, r in found.items()} == {i: t for i, _, t, _ in docs} | {6: "own text"}
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in found.values())
    single = corpus_pipeline.drop_near_duplicates(spark, corpus_pipeline.materialize(lines), sf).collect()
    assert sorted(r.doc_id for r in single) == [1, 3, 6, 7] and page in {r.text for r in single}


def test_xxhash_seed(spark):
    """Spark's xxhash64 of one string is XXH64 with seed 42."""
    own = spark.sql("SELECT xxhash64('héllo')").first()[0]
    assert own % 2 ** 64 == xxhash.xxh64_intdigest("héllo".encode(), 42)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stage_on_odd_rows(spark, sf, odd, empty, name):
    """Each stage on missing, empty, very long and repeated texts with columns of
    clashing names, and on no rows."""
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = odd.withColumn("n_chars", F.length("text").cast("long"))
    clash = ["__score", "__cut", "__hits", "__id", "__hash", "__row", "ids", "root", "component_id", "contaminated"]
    docs = docs.withColumns({c: F.lit("clash") for c in clash})
    out = stage(spark, docs, sf)
    found = out.toPandas()
    if name == "byte_bpe":
        assert len(found) == docs.count()
        own = {(i if pd.notna(i) else None, d) for i, d in zip(found.doc_id, found.decoded_sha256)}
        assert own == {(r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect()}
    else:
        assert out.columns == docs.columns
        assert all(r[c] == "clash" for r in out.collect() for c in (*clash, "fp", "hits", "score", "cut"))
        before = {(r.doc_id, r.text, r.fp) for r in docs.collect()}
        after = [(r.doc_id, r.text, r.fp) for r in out.collect()]
        if name == "line_dedup":  # ids and rows stay; missing texts stay missing
            assert sorted(map(str, [a[0] for a in after])) == sorted(str(r.doc_id) for r in docs.collect())
            assert sum(a[1] is None for a in after) == 2
        else:
            assert set(after) <= before
        if name == "decontaminate":  # nothing here is of the benchmark
            assert len(after) == docs.count()
    none = stage(spark, docs.limit(0), sf)
    assert none.count() == 0 and none.columns == out.columns

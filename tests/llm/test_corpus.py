"""Operators that look across documents, and the pipeline."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from firmscope.llm import graph, mixing, packing, queries, simhash, substring, toxicity, vectors
from firmscope.shared import stored
from tests.compare import difference
from tests.llm import brute
from tests.llm.conftest import DATA, TEXT


def test_substring_duplicates(spark, texts):
    found = queries.QUERIES["op3_substring_dedup"](spark, DATA).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == brute.substring(texts)


def test_substring_in_many_blocks(spark):
    """Passages over blocks, inside one document, and whose sources change in the middle."""
    luck = np.random.default_rng(5)
    pool = [" ".join(f"w{k}" for k in luck.integers(0, 12, 40)) for _ in range(8)]
    rows = []
    for k in range(120):
        parts = [pool[j] if luck.random() < 0.6 else " ".join(f"u{x}" for x in luck.integers(0, 9, 25)) for j in luck.integers(0, 8, 5)]
        rows.append((k, "  ".join(parts) + ("\n" if k % 3 else "")))
    rows.append((500, "z " * 70))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = brute.substring(rows)
    for size in (1_000, 1 << 22):
        found = substring.duplicate_factors(docs, size).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == expected
    text = dict(rows)
    for row in found:
        own = brute.spaced(text[row.doc_id])
        for f in row.factors:
            source = brute.spaced(text[f.source_doc])
            assert own[f.start : f.start + f.length] == source[f.source_start : f.source_start + f.length]
            assert (f.source_doc, f.source_start) < (row.doc_id, f.start) and f.length >= substring.WINDOW


def _block(rows):
    """A block of rows as the operator packs them."""
    table = pa.table({"doc_id": pa.array([k for k, _ in rows], pa.int64()), "text": [t for _, t in rows]})
    batch = pa.Table.from_struct_array(pa.chunked_array([table.to_struct_array().combine_chunks()]))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_table(batch)
    return pa.table({"block": pa.array([0], pa.int64()), "stream": [zstandard.ZstdCompressor().compress(sink.getvalue().to_pybytes())]})


def test_words_decide_how_long_a_factor_is():
    """Proposals are read against the source's words, to the end of its row at most."""
    left = _block([(4, "a b"), (5, " ".join(f"s{k}" for k in range(60))), (6, "t " * 30)])

    def asked(place, words, key=5):
        text = " ".join(words).encode()
        return {"block": 3, "start": 100, "length": len(words), "source_key": key, "source_place": place, "words": text}

    source = [f"s{k}" for k in range(60)]
    rows = [
        asked(0, source[:40]),
        asked(7, [*source[7:32], "other", *source[33:50]]),
        asked(20, [*source[20:], "t", "t"]),
        asked(20, [*source[20:38], "other", *source[39:]]),
        asked(0, source[:30], key=6),
        {**asked(0, source[:25]), "words": None},
    ]
    schema = pa.schema(substring._PROPOSED)
    read = substring._read(left, pa.Table.from_pylist(rows, schema))
    assert read["length"].to_pylist() == [40, 25, 40, 25]
    assert read["source_place"].to_pylist() == [0, 7, 20, 0]
    spaced = {**rows[0], "words": b"\t".join(w.encode() for w in source[:40])}
    assert substring._read(left, pa.Table.from_pylist([spaced], schema))["length"].to_pylist() == [40]


def test_factors_are_taken_from_left_to_right():
    start, length = np.array([0, 0, 5, 30, 41, 45, 100]), np.array([25, 40, 20, 25, 20, 20, 20])
    assert substring._taken(start, length).tolist() == [1, 3, 4, 5, 6]
    assert substring._taken(start[:0], length[:0]).tolist() == []


def test_a_factor_runs_on_where_sources_change(spark):
    """The middle of a copied passage stands by itself in between: one factor covers the passage."""
    middle = [f"m{k}" for k in range(24)]
    passage = [*(f"a{k}" for k in range(40)), *middle, *(f"c{k}" for k in range(40))]
    rows = [(1, " ".join(passage)), (2, " ".join(middle)), (3, "x " + " ".join(passage) + " y")]
    for size in (100, 1 << 22):
        found = {r.doc_id: r for r in substring.duplicate_factors(spark.createDataFrame(rows, "doc_id long, text string"), size).collect()}
        assert [found[k].n_removed for k in (1, 2, 3)] == [0, 24, 104]
        assert [tuple(f) for f in found[3].factors] == [(1, 104, 1, 0)]


def test_rows_without_an_id_are_spread_and_ordered(spark):
    body = " ".join(f"b{k}" for k in range(25))
    rows = [(None, f"{body} {'t' * k} {k}") for k in range(40)] + [(7, f"{body} seven")]
    found = substring.duplicate_factors(spark.createDataFrame(rows, "doc_id long, text string"), 500).collect()
    assert [r.n_removed for r in found if r.doc_id == 7] == [0]
    assert [r.n_removed for r in found if r.doc_id is None] == [25] * 40
    nameless = spark.createDataFrame(rows[:-1], "doc_id long, text string")
    found = substring.duplicate_factors(nameless, 500).collect()
    assert sorted(r.n_removed for r in found) == [0] + [25] * 39


def test_cut_texts(spark):
    body = TEXT + " extra"
    rows = [(1, f"first line\n{body}", 5), (2, f"Second:\n\n{body}\n the end", 6), (3, "short  text\n", 7)]
    found = substring.without_duplicates(spark.createDataFrame(rows, "doc_id long, text string, n_chars int")).collect()
    assert {r.doc_id: r.text for r in found} == {1: rows[0][1], 2: "Second:\n the end", 3: rows[2][1]}
    assert all(r.n_chars == len(r.text) for r in found)


def test_vectors(spark):
    luck = np.random.default_rng(2)
    base = luck.normal(size=(60, 10))
    x = np.concatenate([base + luck.normal(size=base.shape) * s for s in (0, 0.12, 0.2, 0.3)] + [base[:20], 3 * base[:5]])
    rows = [(int(k), [float(c) for c in v]) for k, v in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 10), (902, [float("nan")] + [1.0] * 9), (903, [None] + [1.0] * 9), (904, [1.0, 2.0]), (905, [])]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    expected = brute.classes(list(range(len(x))), near)
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in vectors.linked_vectors(df).collect()}
    assert all(found[k].n_links == near[k].sum() and found[k].component_id == expected[k] for k in range(len(x)))
    assert all((found[k].n_links, found[k].component_id, found[k].kept) == (0, k, True) for k, _ in odd)


def test_vectors_probe_enough(spark, monkeypatch):
    """Recall with many lists, and the same counts when lists are cut into tiles."""
    luck = np.random.default_rng(4)
    centres = luck.normal(size=(150, 16))
    x = (centres[:, None] + luck.normal(size=(150, 8, 16)) * 0.13).reshape(-1, 16)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(vectors, "PER_LIST", 60)
    plain = {r.vec_id: r.n_links for r in vectors.linked_vectors(df).collect()}
    assert sum(plain.values()) >= 0.9 * near.sum() and all(plain[k] <= near[k].sum() for k in plain)
    monkeypatch.setattr(vectors, "TILE", 20)
    monkeypatch.setattr(vectors, "ASKING", 90)
    assert {r.vec_id: r.n_links for r in vectors.linked_vectors(df).collect()} == plain


def test_long_lists_are_divided(spark, monkeypatch):
    """Few first lists for many vectors: parts are probed, nearly no link is lost and none made up."""
    monkeypatch.setattr(vectors, "PER_LIST", 20)
    monkeypatch.setattr(vectors, "MOST_LISTS", 8)
    monkeypatch.setattr(vectors, "ASKING", 300)
    monkeypatch.setattr(vectors, "TILE", 15)
    luck = np.random.default_rng(2)
    centres = luck.normal(size=(500, 16))
    x = np.concatenate([centres + luck.normal(size=centres.shape) * s for s in (0.0, 0.05, 0.12, 0.2, 0.25)])
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    found = {r.vec_id: r for r in vectors.linked_vectors(df).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = (unit @ unit.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    got = np.array([found[k].n_links for k in range(len(x))])
    assert (got <= linked.sum(1)).all() and got.sum() >= 0.97 * linked.sum() > 1000
    groups = brute.classes(list(range(len(x))), linked)
    assert sum(found[k].component_id == groups[k] for k in groups) >= 0.97 * len(x)


def test_vectors_of_several_lengths(spark):
    """Links of a rarer length are kept, also of one that no sample holds."""
    common, rare = [1.0, 0.0, 0.0], [0.0, 1.0]
    rows = [(k, common) for k in (5, 1, 9)] + [(3, rare), (2, rare), (8, [1.0, 0.0, 0.0, 0.0]), (7, [0.6, 0.8])]
    df = spark.createDataFrame([(k, v, "x") for k, v in rows], "vec_id long, embedding array<float>, label string")
    expected = {1: (2, 1), 5: (2, 1), 9: (2, 1), 2: (1, 2), 3: (1, 2), 8: (0, 8), 7: (0, 7)}
    assert {r.vec_id: (r.n_links, r.component_id) for r in vectors.linked_vectors(df).collect()} == expected
    luck = np.random.default_rng(0)
    many = [(k, luck.normal(size=3 + k % 3).round(1).tolist()) for k in range(600)] + [(-5, [0.1] * 9), (-7, [0.1] * 9), (None, [0.1] * 9)]
    df = spark.createDataFrame(many, "vec_id long, embedding array<double>")
    model = vectors.SAMPLE
    try:
        vectors.SAMPLE = vectors.SAMPLE_PER_LIST = 100
        found = vectors.linked_vectors(df).collect()
    finally:
        vectors.SAMPLE, vectors.SAMPLE_PER_LIST = model, 16
    kept = [(k, np.array(v)) for k, v in many if any(v)]
    cosine = lambda a, b: a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)
    linked = {k: sum(len(v) == len(w) and cosine(v, w) >= 0.95 - 1e-12 for j, w in kept if j != k) for k, v in kept}
    assert {r.vec_id: r.n_links for r in found} == {k: linked.get(k, 0) for k, _ in many}
    assert {r.component_id for r in found if r.vec_id in (-5, -7, None)} == {-7}


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.linked_vectors(df).collect() == []
    df = spark.createDataFrame([(1, None), (1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in vectors.linked_vectors(df).collect()] == [(1, 0, 1, True)] * 2


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    found = queries.QUERIES["op7_best_fit_packing"](spark, DATA).collect()
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    expected = {}
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start : start + 4096], "<u4")
            expected[doc_id, piece] = start, len(part), zlib.crc32(part.tobytes())
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found} == expected
    check_sequences(found)


def check_sequences(found, limit=4096):
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


def test_ids_of_odd_texts(spark):
    from tokenizers import Tokenizer

    made = ["İstanbul ŞẞΣς don't we'll 12x34 <|endoftext|>a é ṩ  \u0085 \x1c\x7f ŉ ﬁ 한국어 ½²  a　b\t\nz!!??..", "A'S 'tis I'M x’s ǅ ª º µ ſ"]
    found = packing.cut(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string"), with_ids=True).collect()
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    for r in found:
        assert r.ids == [*tokenizer.encode(made[r.doc_id], add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("spread", [(1, 4096), (1400, 2048), (900, 2500), (5, 90)])
def test_plans_waste_little(spread):
    lengths, counts = np.unique(np.random.default_rng(1).integers(*spread, 5000), return_counts=True)
    plan = packing.plan_packing(dict(zip(lengths.tolist(), counts.tolist(), strict=True)))
    slots = {}
    for length, count, first, offset in plan.runs:
        for k in range(count):
            slots.setdefault(first + k, []).append((offset, length))
    assert sorted(length for parts in slots.values() for _, length in parts) == np.repeat(lengths, counts).tolist()
    for parts in slots.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 4096
    bins = []  # first fit, longest first
    for length in np.repeat(lengths, counts)[::-1].tolist():
        k = next((k for k, room in enumerate(bins) if room >= length), len(bins))
        bins[k:] = [4096] if k == len(bins) else bins[k:]
        bins[k] -= length
    assert plan.sequences <= 1.03 * len(bins) + 2


def test_packed_sequences_hold_the_documents(spark):
    docs = spark.createDataFrame([(k, f"{TEXT} {k}") for k in range(400)], "doc_id long, text string").repartition(3)
    found = packing.pack(docs, limit=100, with_ids=True)
    rows = found.collect()
    assert check_sequences(rows, 100) >= 400 * 28 / 100
    sequences = {r.sequence_id: r.ids for r in packing.sequences(found).collect()}
    assert all(sequences[r.sequence_id][r.offset : r.offset + r.length] == r.ids for r in rows)


def test_mix(spark, documents, texts):
    found = queries.QUERIES["op9_source_mix"](spark, DATA).collect()
    again = queries.QUERIES["op9_source_mix"](spark, DATA).collect()
    assert sorted(map(str, found)) == sorted(map(str, again)) and len(found) == len(texts)
    sizes = {i: len(brute.spaced(t)) for i, t in texts}
    assert all(r.size == sizes[r.doc_id] and 0 <= r.taken <= 2 * r.size for r in found)
    totals, taken = {}, {}
    for r in found:
        totals[r.source] = totals.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    target = brute.targets(totals)
    for r in found:
        assert r.source_size == totals[r.source] and r.target == pytest.approx(target[r.source])
        assert abs(taken[r.source] - r.target) <= 2 * mixing.BLOCK


def test_apportion(spark):
    luck = np.random.default_rng(6)
    rows, expected = [], []
    for group in range(12):
        votes = [int(v) for v in luck.choice([0, 1, 5, 5, 90, 1000, 12345], luck.integers(1, 9))]
        seats = int(luck.integers(0, 60))
        quotas = brute.sainte_lague(votes, seats)
        rows += [(None if group == 0 else f"g{group}", k, v, seats) for k, v in enumerate(votes)]
        expected += [(None if group == 0 else f"g{group}", k, q) for k, q in enumerate(quotas)]
    df = spark.createDataFrame(rows, "g string, k int, votes long, seats long")
    found = mixing.apportion(df, ["g"], [F.col("k")], "votes", "seats").collect()
    assert sorted(((r.g, r.k, r.quota) for r in found), key=str) == sorted(expected, key=str)


def test_mix_in_many_shards(spark, documents):
    found = mixing.mix(documents, block=8, shard_words=700).collect()
    taken, target = {}, {}
    for r in found:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target, r.source_size
        assert r.taken <= 2 * r.size
    for source, (goal, size) in target.items():
        assert abs(taken[source] - goal) <= 16 * (2 + size / 700)


def test_mixed_documents_hold_the_words_taken(documents):
    counted = {r.doc_id: r.taken for r in mixing.mix(documents).collect()}
    found = {}
    for r in mixing.mixed_documents(documents).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + len(brute.spaced(r.text))
        assert r.n_chars == len(r.text) and r.text
    assert found == {i: n for i, n in counted.items() if n}


def test_simhash(spark, texts):
    found = queries.QUERIES["op10_simhash"](spark, DATA).collect()
    ids = [i for i, _ in sorted(texts)]
    fps = np.array([brute.fingerprint(t) for _, t in sorted(texts)], np.uint64)
    expected = brute.classes(ids, np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {
        i: (f"{int(f):016x}", expected[i]) for i, f in zip(ids, fps, strict=True)
    }


@pytest.mark.parametrize("tile", [4096, 16])
def test_links_lose_no_pair(spark, monkeypatch, tile):
    """Fingerprints around few centres, some buckets hot, against all pairs."""
    monkeypatch.setattr(simhash, "TILE", tile)
    luck = np.random.default_rng(8)
    made = set()
    for centre in luck.integers(0, 1 << 62, 12).tolist():
        for _ in range(60):
            made.add(centre ^ sum(1 << int(b) for b in luck.choice(64, luck.integers(0, 4), replace=False)))
    made |= set(luck.integers(0, 1 << 62, 300).tolist()) | {0, (1 << 64) - 1, (1 << 64) - 8}
    fps = np.array(sorted(made), np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    expected = brute.classes(list(range(len(fps))), near)
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    found = {r.node: r.root for r in graph.components(simhash.links(df)).collect()}
    place = {int(f): k for k, f in enumerate(fps.view(np.int64))}
    groups = {}
    for f, k in place.items():
        groups.setdefault(found.get(f, f), set()).add(k)
    wanted = {}
    for k, least in expected.items():
        wanted.setdefault(least, set()).add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_plans_deal_all_units(distance):
    fps = np.random.default_rng(1).integers(0, 1 << 62, 3000).astype(np.uint64)
    for n in (100, 10**6, 10**9):
        parts = simhash.plan(fps, n, distance)
        assert sum(units for _, units in parts) == distance + 1
        masks = [m for m, _ in parts]
        assert sum(m.bit_count() for m in masks) == len({b for m in masks for b in range(64) if m >> b & 1})


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in graph.components(links).collect()}
    assert found == {**{k: 0 for k in range(1, 201)}, 501: 500}


def test_one_of_each_group_stays(odd):
    found = simhash.deduplicated(odd).collect()
    assert found[0].__fields__ == odd.columns
    ids = sorted(r.doc_id for r in found if r.doc_id is not None)
    assert ids == [1, 3, 6, 7, 8] and sum(r.doc_id is None for r in found) == 1


def test_stages_take_columns_of_any_name_and_type(strange, labels):
    n = strange.count()
    kept = toxicity.without_toxic(strange, labels)
    assert kept.columns == strange.columns and 0 < kept.count() <= n
    for stage in (simhash.deduplicated, substring.without_duplicates, mixing.mixed_documents):
        out = stage(strange)
        assert out.columns == strange.columns and out.dtypes == strange.dtypes
        assert all(row["my.col"] == 1 and row["a map"] == {"k": row["`deep`"][0][0]["k"]} for row in out.collect())


def test_mix_spreads_rows_without_an_id(spark, documents):
    """Rows without an id are dealt over as many shards as rows with one."""
    shards = {}
    distinct = documents.dropDuplicates(["text"])
    for name, docs in (("with", distinct), ("without", distinct.withColumn("doc_id", F.lit(None).cast("long")))):
        sized = mixing._sized(docs, 1)
        sources, parts = mixing.quotas(sized, 8, 500)
        shards[name] = {r.source: r.n for r in parts.groupBy("source").agg(F.count("*").alias("n")).collect()}
        assert sized.select("mark").distinct().count() == docs.count()
    used = {name: sum(own.values()) for name, own in shards.items()}
    assert abs(used["without"] - used["with"]) <= 0.1 * used["with"]


def test_quotas_in_groups_of_shards(spark, documents, texts, monkeypatch):
    """With few shards to a group, quotas still add up and each source comes near its target."""
    monkeypatch.setattr(mixing, "GROUP", 3)
    rows = mixing.mix(documents, shard_words=400).collect()
    taken, target = {}, {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    shards = mixing.quotas(mixing._sized(documents, 11), 8, 400)[1].groupBy("source").count().collect()
    for row in shards:
        assert abs(taken[row.source] - target[row.source]) <= 8 * row["count"] + 8


def test_odd_documents(odd):
    n = odd.count()
    found = substring.duplicate_factors(odd).collect()
    assert len(found) == n and sorted(r.n_removed for r in found if r.doc_id == 2) == [23, 23]
    assert [r.n_removed for r in found if r.doc_id is None] == [23]
    cut = substring.without_duplicates(odd)
    assert cut.columns == odd.columns and cut.count() == n
    mixed = mixing.mix(odd).collect()
    assert len(mixed) == n and {r.taken for r in mixed if r.doc_id in (3, 4, 5)} == {0}
    assert mixing.mixed_documents(odd).columns == odd.columns
    packed = packing.pack(odd).collect()
    check_sequences(packed)
    assert sum(r.doc_id == 2 for r in packed) == 2 and {r.length for r in packed if r.doc_id in (3, 4, 5)} == {1}
    linked = simhash.near_duplicates(odd).collect()
    assert len(linked) == n and {r.component_id for r in linked if r.doc_id in (3, 4, 5)} == {3}


def test_no_documents(none):
    for df in (
        substring.duplicate_factors(none),
        substring.without_duplicates(none),
        mixing.mix(none),
        mixing.mixed_documents(none),
        packing.pack(none),
        simhash.near_duplicates(none),
        simhash.deduplicated(none),
    ):
        assert df.collect() == []


def test_pipeline(spark, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "substring_dedup", "source_mix", "packing"]
    docs = documents
    rows = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, DATA), "stage")
        assert out.columns == documents.columns
        rows.append(out.count())
        docs = out
    assert documents.count() >= rows[0] >= rows[1] == rows[2]
    whole = corpus_pipeline.run(spark, DATA).collect()
    check_sequences(whole)
    assert {r.doc_id for r in whole} == {r.doc_id for r in docs.select("doc_id").collect()}


@pytest.mark.parametrize("name", queries.SQL)
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql(spark, name, sf):
    assert difference(spark, queries.QUERIES[name], queries.SQL[name], f"/root/testdata/{sf}") is None

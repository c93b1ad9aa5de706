"""Corpus operators against brute force, the libraries they match, and planted cases."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

import corpus_pipeline
from lingmill.llm import (
    byte_bpe,
    components,
    decontamination,
    hnsw,
    line_quality,
    near_vectors,
    repeats,
    sharding,
    simhash,
    token_counts,
    token_files,
    toxicity,
)

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, words):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(words))


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, ties, strange characters."""
    base = prose(1, 60)
    texts = [
        (1, base), (2, base), (2, base), (3, None), (4, ""), (None, base), (None, "alone"), (5, "  \n\t "),
        (6, base + " tail"), (7, prose(2, 3000)), (8, "Äß 'll don't  ①  x y z \x1c q ▁a▁▁b"),
        (9, prose(3, 25) + " " + prose(1, 60)[6:200] + " end"), (10, "x" * 3000), (11, "Idiot!! " * 5 + "\r\n\f\x0b"),
        (12, "<|endoftext|> a<|endoftext|>b"), (13, "one two"), (2, prose(4, 40)),
    ]
    rows = [(d, t, "en" if i % 2 else None, "s", None) for i, (d, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOC).withColumns({"ids": F.lit(1), "fingerprint": F.lit("clash"), "__extra": F.lit(None)})


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOC)


def plain(df):
    return [r.asDict() for r in df.collect()]


def test_byte_bpe_equals_the_library_and_round_trips(odd_docs, no_docs):
    ranks = byte_bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = odd_docs.select("doc_id", "text")
    out = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, keep=("doc_id", "text")), RANKS)
    for row in plain(out):
        text = row["text"] or ""
        assert np.frombuffer(row["ids"], "<u4").tolist() == library.encode_ordinary(text)
        assert row["decoded"] == text.encode()
    assert byte_bpe.encode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", min_size=2, max_size=5), max_size=12, unique=True), st.text("abc", max_size=30))
def test_backtracking_equals_plain_merging(tokens, text):
    ranks = {bytes([b]): b for b in range(256)}
    for token in tokens:
        ranks.setdefault(token.encode(), len(ranks))
    data = text.encode()
    got = byte_bpe.Encoder(ranks).encode(data)
    want = [data] if data in ranks else byte_bpe.merged(data, ranks)
    assert got == [ranks[t] for t in want]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=14), st.randoms(), st.booleans(), st.text("abc", max_size=30))
def test_any_order_of_ranks_equals_plain_merging(joins, chance, shuffled, text):
    tokens = [b"a", b"b", b"c"]
    for left, right in joins:
        tokens.append(tokens[left % len(tokens)] + tokens[right % len(tokens)])
    tokens = list(dict.fromkeys(t for t in tokens if len(t) < 12))
    if shuffled:
        chance.shuffle(tokens)
    ranks = {token: rank for rank, token in enumerate(tokens)}
    data = text.encode()
    want = [data] if data in ranks else byte_bpe.merged(data, ranks)
    assert byte_bpe.Encoder(ranks).encode(data) == [ranks[t] for t in want]


def test_new_neighbours_cost_no_new_merging(monkeypatch):
    ranks = byte_bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    plain_merging, merges = byte_bpe.merged, Counter()

    def counted(data, *args, **options):
        merges[data] += 1
        return plain_merging(data, *args, **options)

    monkeypatch.setattr(byte_bpe, "merged", counted)
    encoder = byte_bpe.Encoder(ranks)
    rng = np.random.default_rng(80)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzäé"), 12)) for _ in range(3000)]
    for word in words:
        assert encoder.encode(word.encode()) == library.encode_ordinary(word)
    # Only tokens of the vocabulary, each once.
    assert set(merges) <= set(ranks) and max(merges.values()) == 1


def test_token_files_round_trip(spark, odd_docs, no_docs, tmp_path):
    out = str(tmp_path / "files")
    token_files.write(odd_docs, out, WORDS, 1)
    library = Tokenizer.from_file(WORDS)
    got = plain(token_files.read(spark, out))
    want = Counter(
        (r["doc_id"], tuple([*library.encode(r["text"] or "", add_special_tokens=False).ids, 1])) for r in plain(odd_docs)
    )
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == want
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    numbers = token_files.number_table(spark, out)[0]
    counts = np.bincount(np.concatenate([np.frombuffer(r["ids"], "<u4") for r in got]), minlength=len(numbers))
    assert (np.diff(counts[numbers]) <= 0).all()
    empty = str(tmp_path / "none")
    token_files.write(no_docs, empty, WORDS, 1)
    assert token_files.read(spark, empty).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=40))
def test_packed_numbers_come_back(numbers):
    control, data = token_files.pack(np.array(numbers, dtype=np.uint32))
    assert token_files.unpack(control, data, len(numbers)).tolist() == numbers
    assert len(control) == -(-len(numbers) // 4)


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_token_counts_equal_the_library(spark, odd_docs, byte_fallback):
    pieces = token_counts.read_pieces(PIECES)
    least = min(score for _, score in pieces)
    spare = [(f"<0x{i:02X}>", least) for i in range(256)]
    model = models.Unigram([("<unk>", -1.0), *pieces, *spare], unk_id=0, byte_fallback=byte_fallback)
    library = Tokenizer(model)
    library.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(prepend_scheme="always")]
    )
    out = token_counts.with_token_count(odd_docs.select("doc_id", "text"), pieces, byte_fallback=byte_fallback)
    for row in plain(out):
        assert row["n_tokens"] == len(library.encode(row["text"] or "", add_special_tokens=False).ids), row


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    counts = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(nodes, linked):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_simhash_of_odd_texts(odd_docs, no_docs):
    got = plain(simhash.near_duplicates(odd_docs.drop("fingerprint"), keep=("text",)))
    assert len(got) == odd_docs.count()
    prints = {r["text"]: brute_fingerprint(r["text"]) for r in got}
    assert all(r["fingerprint"] % 2**64 == prints[r["text"]] for r in got)
    linked = [(a, b) for a in prints.values() for b in prints.values() if (a ^ b).bit_count() <= 2]
    label = brute_components(prints.values(), linked)
    for row in got:
        same = [r["doc_id"] for r in got if label[prints[r["text"]]] == label[prints[row["text"]]]]
        assert row["component"] == min((d for d in same if d is not None), default=None)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_every_close_pair_of_fingerprints_is_connected(spark):
    rng = np.random.default_rng(5)
    start = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    prints = set(start.tolist())
    for _ in range(400):
        one = list(prints)[rng.integers(len(prints))]
        for bit in rng.integers(0, 64, rng.integers(1, 5)):
            one ^= 1 << int(bit)
        prints.add(one)
    signed = [(p - (1 << 64) if p >= 1 << 63 else p,) for p in prints]
    links = simhash.links(spark.createDataFrame(signed, "fingerprint long"))
    got = brute_components(prints, [(r["a"] % 2**64, r["b"] % 2**64) for r in links.collect()])
    all_pairs = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    assert got == brute_components(prints, all_pairs)
    assert links.count() < len(prints) * 28


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(300)]
    links = spark.createDataFrame([*path, *star, (5, 5), (None, 3)], "a long, b long")
    groups = {}
    for row in components.components(links, "a", "b").collect():
        groups.setdefault(row["component"], set()).add(row["node"])
    assert sorted(map(len, groups.values())) == [301, 301]


def test_shards_are_exact_and_uniform(spark, no_docs):
    rows = spark.range(0, 1000, 1, 7).selectExpr("id", "cast(null as string) as n")
    got = sharding.shuffle_into_shards(rows, 24).toPandas()
    assert sorted(got["id"]) == list(range(1000))
    sizes = got.groupby("shard").size()
    assert sizes.min() >= 41 and sizes.max() <= 42 and len(sizes) == 24
    assert all(sorted(g) == list(range(len(g))) for _, g in got.groupby("shard")["slot"])
    assert sharding.shuffle_into_shards(no_docs, 24).count() == 0
    assert sorted(sharding.shuffle_into_shards(spark.range(3), 24).toPandas()["slot"]) == [0, 0, 0]


def test_the_matrix_is_drawn_by_many_tasks_and_exact(spark):
    sizes = spark.range(300).select(F.col("id").alias("part"), (F.col("id") % 7 * 3).alias("n"))
    matrix = sharding.communication_matrix(sizes, 24, 1)
    counts = {r["part"]: r["counts"] for r in matrix.collect()}
    given = {r["part"]: r["n"] for r in sizes.collect()}
    assert {p: sum(c) for p, c in counts.items()} == given
    totals = np.array(list(counts.values())).sum(axis=0)
    assert totals.sum() == sum(given.values()) and totals.max() - totals.min() <= 1
    # The halves of the last written step lie in many partitions.
    assert matrix.select(F.spark_partition_id()).distinct().count() > 1
    files = sharding.settle(spark.range(64).repartition(16, "id"), "spread").inputFiles()
    assert len(files) > 8


def test_sharding_query_keeps_its_law(spark):
    from lingmill.llm import queries

    sf_dir = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.QUERIES["op1_hypergeometric_shards"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        row, text = got[doc["doc_id"]], (doc["text"] or "").encode()
        assert row["size"] == len(text) + 8 and row["text_crc32"] == zlib.crc32(text)
        assert row["law"] == "rows" and row["grown_shard"] is None
    shards = Counter(r["shard"] for r in got.values())
    assert set(shards) == set(range(24)) and max(shards.values()) - min(shards.values()) <= 1
    for shard in range(24):
        assert sorted(r["slot"] for r in got.values() if r["shard"] == shard) == list(range(shards[shard]))


def test_hypergeometric_draws_follow_the_law(spark):
    draws = spark.range(4000).select(
        sharding.hypergeometric(F.lit(30), F.lit(20), F.lit(50), sharding.uniform(F.lit(9), F.col("id"))).alias("x")
    ).toPandas()["x"]
    spread = 30 * 0.4 * 0.6 * 20 / 49
    assert abs(draws.mean() - 12) < 4 * (spread / 4000) ** 0.5
    assert abs(draws.var() - spread) < 0.4
    assert draws.between(0, 20).all()


def brute_repeats(rows):
    first = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - 19):
            here = (2**63 if doc is None else doc, i)
            first[tuple(words[i : i + 20])] = min(first.get(tuple(words[i : i + 20]), here), here)
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - 19):
            if first[tuple(words[i : i + 20])] < (2**63 if doc is None else doc, i):
                gone.update(range(i, i + 20))
        yield doc, len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def test_repeats_equal_brute_force(spark, odd_docs, no_docs):
    more = [(100 + i, prose(50 + i % 4, 30) + " " + prose(i, 5) + " " + prose(50 + (i + 1) % 4, 22)) for i in range(40)]
    more.append((99, " ".join(["same"] * 70)))
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = Counter(
        (r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in plain(repeats.remove_repeats(docs))
    )
    assert got == Counter(brute_repeats([(r["doc_id"], r["text"]) for r in plain(docs)]))
    clash = odd_docs.withColumns({"kept": F.lit(1), "order": F.lit("x"), "t1": F.lit(None), "places": F.lit(2)})
    assert clash.count() == repeats.remove_repeats(clash).count()
    assert repeats.remove_repeats(clash).columns == [*odd_docs.columns, "order", "t1", "places", "n_words", "n_removed", "kept"]
    assert repeats.remove_repeats(no_docs).count() == 0


def thue_morse(letters, flip):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(letters))


def test_words_of_equal_polynomial_hashes_are_told_apart(spark):
    """The two long words differ by a sum that vanishes for any odd base."""
    lead = prose(1, 20)
    rows = [(i, f"{lead} {thue_morse(1024, i)} {prose(2, 19)}") for i in range(2)]
    assert len(set(repeats.read_words([t.encode() for _, t in rows]).hashes[[20, 60]].tolist())) == 1
    got = {r["doc_id"]: r["n_removed"] for r in plain(repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert got == {0: 0, 1: 20}


def test_a_very_long_text_is_read_in_stretches(spark):
    rng = np.random.default_rng(4)
    words = [f"w{x}" for x in rng.integers(0, 90_000, 420_000).tolist()]
    words[150_000:150_060] = words[10:70]  # and a passage across the end of the first stretch
    first = next(repeats.pieces(" ".join(words).encode()))
    words[400_000:400_040] = words[len(first.split()) - 20 : len(first.split()) + 20]
    rows = [(1, " ".join(words)), (2, " ".join(words[149_990:150_050]))]
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in plain(repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))))
    assert got == Counter(brute_repeats(rows))
    assert {k[:3] for k in got} == {(1, 420_000, 100), (2, 60, 60)}


def test_each_window_is_in_one_stretch(monkeypatch):
    monkeypatch.setattr(repeats, "HASH_BYTES", 50)
    words = [f"{i:03d}".encode() for i in range(400)]
    seen = [begin + i for begin, part in repeats.stretches(b"  ".join(words)) for i in range(max(len(part.split()) - 19, 0))]
    assert seen == list(range(381))


def test_first_windows_are_exchanged_once_and_copies_dealt_apart():
    rows = np.array([[0, key, 7 + key, place, place, 5] for key in range(1000) for place in range(2) for _ in range(2)])
    out = repeats.compared(rows).to_pandas()
    packed = out[out["later"].notna()]
    assert len(out) - len(packed) == 2 and len(packed) == 999 and packed["high"].nunique() == 999


def brute_align(item, passage):
    best = 0.0
    table = [[0.0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            match = 1.0 if a == b and a else -0.5
            table[i][j] = max(0.0, table[i - 1][j - 1] + match, table[i - 1][j] - 0.5, table[i][j - 1] - 0.5)
            best = max(best, table[i][j])
    return best


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=15))
def test_alignment_equals_brute_force(item, passage):
    score, start, end = decontamination.align(np.array(item, dtype=int), np.array(passage, dtype=int))
    assert score == brute_align(item, passage)
    assert brute_align(item, passage[start:end]) == score


def test_edited_benchmark_passages_are_found(spark, odd_docs, no_docs):
    items = [(i, prose(700 + i, 40)) for i in range(5)]
    words = items[3][1].split()
    edited = " ".join("changed" if i % 7 == 3 else w for i, w in enumerate(words) if i % 11)
    planted = [(500, prose(8, 50) + " " + items[1][1].upper() + ". " + prose(9, 50)), (501, prose(10, 30) + " " + edited)]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(planted, "doc_id long, text string"))
    bench = spark.createDataFrame([*items, (None, "a b c d"), (9, None), (10, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in plain(decontamination.contaminated(docs, bench))}
    assert set(got) == {(500, 1), (501, 3)}
    assert got[500, 1]["score"] == 1 and (got[500, 1]["start"], got[500, 1]["end"]) == (50, 90)
    assert decontamination.contaminated(no_docs, bench).count() == 0
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0


def test_seeds_find_nearly_all_edited_copies():
    """Of edited copies that align well enough, the share that has a seed."""
    rng = np.random.default_rng(7)
    texts = [prose(300 + i, 40) for i in range(30)]
    items = decontamination.Items(list(range(30)), texts)
    items.choose_seeds(rng.integers(1, 1000, len(items.number) + 1).astype(float))
    good = found = 0
    for trial in range(900):
        which = trial % 30
        swap, insert = [(0.1, 0.0), (0.3, 0.0), (0.2, 0.2)][trial % 3]
        passage = []
        for word in items.items[which].tolist():
            passage.append(0 if rng.random() < swap else word)
            if rng.random() < insert:
                passage.append(0)
        numbers = np.array([0] * 20 + passage + [0] * 20, dtype=np.int64)
        if decontamination.align(items.items[which], numbers)[0] >= decontamination.THRESHOLD * 40:
            good += 1
            found += any(owner == which for owner, _, _ in decontamination.windows(items, numbers))
    assert good > 700 and found >= 0.99 * good


def test_benchmarks_of_many_bytes_take_more_passes(spark, monkeypatch):
    items = [(i, prose(700 + i, 30)) for i in range(6)]
    docs = spark.createDataFrame([(i, prose(i, 20) + " " + t) for i, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, decontamination.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontamination, "BYTES_AT_ONCE", 300)
    assert sorted(map(tuple, decontamination.contaminated(docs, bench).collect())) == one and len(one) == 6


def test_of_conflicting_labels_the_least_is_learned(spark):
    rows = [(i, prose(i, 12) + (" idiot." if i % 2 else ".")) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(i, i % 2, i % 2) for i in range(40)]
    plain_labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    more = spark.createDataFrame(labels + [(i, 1, 1) for i in range(40)], "doc_id long, quality int, toxic int").repartition(7)
    one, other = (toxicity.learn(docs, d) for d in (plain_labels, more))
    assert one.features.tolist() == other.features.tolist()
    one, other = (line_quality.learn(docs, d) for d in (plain_labels, more))
    assert np.array_equal(one.weights, other.weights)


def test_toxic_documents_are_caught(spark, odd_docs, no_docs):
    rows = [(i, prose(i, 40) + (" you idiot " if i % 5 == 0 else " ") + prose(i + 900, 9)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 300)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    chain = toxicity.learn(docs, labels)
    assert chain.names == ["insult", "contempt", "other", "toxic"]
    scored = toxicity.with_toxicity(docs.where("doc_id >= 300"), chain).toPandas()
    assert ((scored["p_toxic"] >= toxicity.THRESHOLD) == (scored["doc_id"] % 5 == 0)).all()
    assert toxicity.with_toxicity(odd_docs, chain).count() == odd_docs.count()
    untrained = toxicity.learn(no_docs, labels)
    assert toxicity.with_toxicity(docs.limit(2), untrained).toPandas()["p_toxic"].tolist() == [0.5, 0.5]


def test_a_key_of_many_rows_is_learned_from_once(spark):
    rows = [(i, prose(i, 12) + (" idiot." if i % 2 else ".")) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    many = docs.union(docs.where("doc_id = 3").crossJoin(spark.range(500)).select("doc_id", F.lit("zzz").alias("text")))
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    one, other = (toxicity.learn(d, labels) for d in (docs, many))
    assert one.features.tolist() == other.features.tolist()
    one, other = (line_quality.learn(d, labels) for d in (docs, many))
    assert np.array_equal(one.weights, other.weights)


def test_seed_keys_of_a_vocabulary_beyond_two_million_words():
    items = decontamination.Items([1, 2], ["alpha beta gamma delta", "delta beta alpha gamma"])
    items.number |= {str(n): n for n in range(5, 3_000_000)}
    items.choose_seeds(np.ones(len(items.number) + 1))
    owner, at = decontamination.seed_hits(items, items.items[1])
    assert (1, 0) in set(zip(owner.tolist(), at.tolist()))


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    evidence, couple = rng.normal(size=5), rng.normal(size=(2, 2))
    counts = np.array([4, 1])
    good, _ = line_quality.marginals(evidence, counts, couple)
    weight, total = np.zeros(4), 0.0
    for number in range(16):
        labels = [number >> i & 1 for i in range(4)]
        p = np.prod([1 / (1 + np.exp(-e if y else e)) for e, y in zip(evidence, labels)])
        p *= np.exp(sum(couple[a, b] for a, b in zip(labels, labels[1:])))
        weight += p * np.array(labels)
        total += p
    assert np.allclose(good[:4], weight / total)
    assert np.isclose(good[4], 1 / (1 + np.exp(-evidence[4])))


def test_line_quality_holds_out_and_separates(spark, odd_docs, no_docs):
    def page(i):
        lines = [prose(i * 31 + k, 12).capitalize() + "." for k in range(6)]
        return "\n".join(lines) if i % 3 else "\n".join(x.upper().replace(" ", "!! ") for x in lines)

    docs = spark.createDataFrame([(i, page(i)) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)], "doc_id long, quality int")
    model = line_quality.learn(docs, labels)
    scored = line_quality.with_score(docs, model).where(line_quality.held_out("doc_id")).toPandas()
    assert len(scored) > 40
    assert ((scored["score"] >= line_quality.THRESHOLD) == (scored["doc_id"] % 3 > 0)).all()
    held = docs.select("doc_id", line_quality.held_out("doc_id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in held)
    odd = line_quality.with_score(odd_docs, model).toPandas()
    assert len(odd) == odd_docs.count() and odd["score"].between(0, 1).all()
    assert line_quality.with_score(no_docs, line_quality.learn(no_docs, labels)).count() == 0


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 16))
    near = base[rng.integers(0, 40, 200)] + rng.normal(size=(200, 16)) * 0.15
    vectors = [*base.tolist(), *near.tolist(), *[base[0].tolist()] * 30]
    rows = [(i, v) for i, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    rows += [(1000 + i, v) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = near_vectors.near_duplicates(df).toPandas().set_index("vec_id")
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1)[:, None]
    true = unit @ unit.T >= 0.9
    np.fill_diagonal(true, False)
    found = got.loc[range(len(vectors)), "n_links"].to_numpy()
    assert (found <= true.sum(axis=1)).all() and found.sum() >= 0.98 * true.sum()
    label = brute_components(range(len(vectors)), list(zip(*np.nonzero(true))))
    same = np.mean([got.loc[i, "component"] == label[i] for i in range(len(vectors))])
    assert same >= 0.98
    rest = got.loc[[1000 + i for i in range(len(odd))]]
    assert (rest["n_links"] == 0).all() and (rest["component"] == rest.index).all() and rest["kept"].all()
    assert near_vectors.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("two_shards", [False, True])
def test_a_dense_group_is_counted_in_blocks(two_shards, monkeypatch):
    monkeypatch.setattr(near_vectors, "EXACT_CELLS", 3000)
    rng = np.random.default_rng(8)
    centre = rng.normal(size=24)
    vectors = np.concatenate([centre + rng.normal(size=(400, 24)) * 0.2, rng.normal(size=(300, 24)), [centre, -centre]])
    vectors = rng.permutation(vectors)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    weights = rng.integers(1, 4, len(vectors))
    ids = 10 + np.arange(len(vectors))
    cut = 300 if two_shards else len(vectors)
    halves = [hnsw.Graph.load(hnsw.build(ids[p], weights[p], vectors[p]).dump()) for p in (slice(0, cut), slice(cut, None)) if len(ids[p])]
    true = vectors @ vectors.T >= 0.9
    if two_shards:
        true[:cut, :cut] = true[cut:, cut:] = False
    np.fill_diagonal(true, False)
    got = near_vectors.matched(halves[0], halves[1] if two_shards else None, 0.9).to_pandas().set_index("node")
    want = (true * weights).sum(axis=1)
    assert (want > 128).sum() > 300
    assert got["links"].reindex(ids, fill_value=0).tolist() == want.tolist()
    label = brute_components(range(len(ids)), list(zip(*np.nonzero(true))))
    root = {n: got.loc[10 + n, "root"] for n in label if want[n]}
    assert len(set(root.values())) == len({label[n] for n in root})
    assert all(root[a] == root[b] for a, b in zip(*np.nonzero(true)))


def rare_links(vectors, links, width, seed):
    """Random directions, a few of them with a near copy."""
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(vectors, width))
    copies = rows[:links] + rng.normal(size=(links, width)) * 0.3
    rows = rng.permutation(np.concatenate([rows, copies]))
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def test_rare_links_are_audited_on_real_links(monkeypatch):
    rows = rare_links(6000, 60, 384, 3)
    graph = hnsw.Graph.load(hnsw.build(np.arange(len(rows)), np.ones(len(rows), dtype=int), rows).dump())
    sample, true = near_vectors.audit_sample(graph, graph.vectors, 0.9, own=True)
    assert len(sample) == 2048 and 0 < true.sum() < near_vectors.AUDIT_LINKS
    got = near_vectors.matched(graph, None, 0.9).to_pandas()
    assert len(got) >= 0.98 * 120 and (got["links"] == 1).all()
    # A beam that finds nothing but the queries themselves is not accepted.
    beams = []
    plain = near_vectors.beam_pairs

    def poor(graph, queries, threshold, beam):
        beams.append(beam)
        a, b, full = plain(graph, queries, threshold, beam)
        keep = (a == b) | (beam > 100)
        return a[keep], b[keep], full

    monkeypatch.setattr(near_vectors, "beam_pairs", poor)
    assert len(near_vectors.matched(graph, None, 0.9)) >= 0.98 * 120
    assert max(beams) > 100


def test_graphs_meet_by_pair_and_not_by_length(spark):
    rows = rare_links(200, 20, 16, 4)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)] + [(900 + i, [1.0, float(i)]) for i in range(2)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in near_vectors.near_duplicates(df, least_shards=3).collect()}
    true = rows @ rows.T >= 0.9
    assert sum(got.values()) >= 0.98 * (true.sum() - len(rows)) and len(got) == 222


def test_columns_of_the_results_names_are_replaced(spark, odd_docs):
    clash = odd_docs.withColumns({c: F.lit("x") for c in ("n_tokens", "score", "p_toxic", "ids", "decoded", "start", "group", "component")})
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1)], "doc_id long, quality int, toxic int")
    others = set(clash.columns)
    scored = line_quality.with_score(clash, line_quality.learn(clash, labels))
    toxic = toxicity.with_toxicity(clash, toxicity.learn(clash, labels))
    counted = token_counts.with_token_count(clash, token_counts.read_pieces(PIECES))
    encoded = byte_bpe.encode(clash, RANKS, public_tokenizers.PATTERN, keep=clash.columns)
    decoded = byte_bpe.decode(encoded, RANKS)
    leaks = decontamination.contaminated(clash, spark.createDataFrame([(1, prose(1, 60))], "item_id long, text string"), keep=["score", "start", "lang"])
    near = simhash.near_duplicates(clash, keep=["fingerprint", "group", "component", "lang"])
    for made, name, kind in (
        (scored, "score", "double"), (toxic, "p_toxic", "double"), (counted, "n_tokens", "bigint"), (encoded, "ids", "binary"),
        (decoded, "decoded", "binary"), (leaks, "score", "double"), (near, "fingerprint", "bigint"),
    ):
        assert dict(made.dtypes)[name] == kind and len(made.columns) == len(set(made.columns))
        assert made.count() > 0
    assert all(set(made.columns) >= others for made in (scored, toxic, counted, decoded))


def test_graph_recall():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 24))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    graph = hnsw.Graph.load(hnsw.build(np.arange(3000), np.ones(3000, dtype=int), vectors).dump())
    found, _ = graph.search(graph.vectors[:300], 64)
    best = np.argsort(-(graph.vectors[:300] @ graph.vectors.T), axis=1)[:, :10]
    assert np.mean([np.isin(b, f).mean() for b, f in zip(best, found)]) >= 0.9


def brute_leaks(text, items):
    """Whether a text aligns with half of an item's words, trying every item on the whole text."""
    number = {}
    coded = [[number.setdefault(w, len(number) + 1) for w in decontamination.words_of(t)] for t in (text, *items)]
    passage = np.array(coded[0], dtype=np.int64)
    return any(decontamination.align(np.array(item), passage)[0] >= decontamination.THRESHOLD * len(item) for item in coded[1:] if item)


@pytest.fixture(scope="module")
def small_corpus(spark, tmp_path_factory):
    """A directory with documents, labels and benchmark: junk, copies, shared passages, leaks."""
    def page(i):
        return "\n".join(prose(i * 31 + k, 14).capitalize() + "." for k in range(5))

    junk = ["click here!!! " * 3, "||||| 0 0 0", "BUY NOW $$$"]
    leak, shared = prose(9001, 30), prose(9002, 60)
    rows = []
    for i in range(240):
        text = page(i) if i % 4 else "\n".join(junk[(i + k) % 3] + str(i) for k in range(6))
        if i % 20 == 1:
            text = page(i) + "\n" + shared.capitalize() + "."
        if i % 30 == 3:
            text = page(3 + 30 * (i % 60 // 30))  # copies
        if i % 50 == 6:
            text = page(i) + "\n" + leak.capitalize() + "."
        rows.append((i, text))
    rows += [(None, page(500)), (None, page(500)), (501, None), (502, ""), (7, page(503))]
    out = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], DOC)
    docs.repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, leak), (2, prose(9003, 25))], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out, rows, [leak, prose(9003, 25)]


def test_run_equals_plain_python(spark, small_corpus):
    """All stages row by row; the scores of the fitted model are taken as given."""
    sf_dir, rows, items = small_corpus
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = line_quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = {(r["doc_id"], r["text"]): r["score"] for r in plain(line_quality.with_score(docs, model))}
    left = [r for r in rows if scores[r] >= line_quality.THRESHOLD]
    assert 150 < len(left) < 200
    prints = [brute_fingerprint(t) for _, t in left]
    linked = [(i, j) for i in range(len(left)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    label = brute_components(range(len(left)), linked)
    groups = {}
    for i, row in enumerate(left):
        groups.setdefault(label[i], []).append(row)
    left = [min(group, key=lambda r: (r[0] is None, r[0] or 0)) for group in groups.values()]
    assert len(left) < 180
    removed = {}
    for (doc_id, text), (_, total, gone, kept) in zip(left, brute_repeats(left)):
        if not total or gone < total:
            removed[doc_id, text] = kept if gone else text
    left = [(doc_id, text) for (doc_id, _), text in removed.items() if not brute_leaks(text or "", items)]
    assert len(removed) - len(left) == 1  # later copies of the leak went as repeats
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    want = Counter()
    for doc_id, text in left:
        ids = np.array(library.encode_ordinary(text or ""), dtype="<u4").tobytes()
        want[doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    got = corpus_pipeline.run(spark, sf_dir)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got.collect()) == want


def test_one_of_each_group_of_copies_stays(spark, odd_docs):
    kept = plain(corpus_pipeline.keep_one_of_near_copies(spark, odd_docs, ""))
    groups = plain(simhash.near_duplicates(odd_docs, keep=("text",)))
    assert len(kept) == len({r["group"] for r in groups})
    empty = odd_docs.limit(0)
    assert corpus_pipeline.keep_one_of_near_copies(spark, empty, "").count() == 0


def test_contaminated_rows_go_by_id_and_text(spark, tmp_path):
    leak = prose(70, 30)
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"{prose(71, 20)} {leak}"), (None, prose(72, 40)), (1, leak), (1, prose(73, 40)), (2, None), (3, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", None) for d, t in rows], DOC)
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert kept.columns == corpus_pipeline.COLUMNS
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter([rows[1], rows[3], *rows[4:]])

"""Best-fit packing, source divergence and fill-in-middle: brute force, exact round trips, nulls, ties, repeats and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyfield.llm import divergence, fill_in_middle, packing, queries

SMALL = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(spark, rows):
    return spark.createDataFrame(rows, DOC)


# ------------------------------------------------------------------ packing


def fewest_by_search(lengths, capacity):
    """The true optimum of a few documents."""
    best = len(lengths)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= lengths[k] and rooms[i] not in rooms[:i]:
                place(k + 1, rooms[:i] + (rooms[i] - lengths[k],) + rooms[i + 1 :])
        place(k + 1, (*rooms, capacity - lengths[k]))

    place(0, ())
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=10), st.integers(20, 30))
def test_search_keeps_every_document_and_its_bound_holds(sizes, capacity):
    lengths = np.array(sorted(sizes, reverse=True))
    begun = packing.best_fit(lengths, capacity)
    left = packing.swap_search(begun, lengths, capacity)
    best = fewest_by_search(lengths.tolist(), capacity)
    assert sorted(sum(left, [])) == list(range(len(lengths)))
    assert all(lengths[b].sum() <= capacity for b in left)
    assert packing.fewest_bins(lengths, capacity) <= best <= len(left) <= len(begun)


def test_swaps_mend_what_best_fit_leaves():
    lengths = np.array([60, 50, 40, 30, 20])  # 100 a bin: two bins are enough
    assert len(packing.swap_search([[0], [1, 2], [3, 4]], lengths, 100)) == 2  # a move
    assert len(packing.swap_search([[0, 3], [1, 4], [2]], lengths, 100)) == 2  # two for one, or one for one
    rng, worse, better = np.random.default_rng(5), 0, 0
    for _ in range(30):
        sizes = rng.integers(150, 400, 120)
        begun = packing.best_fit(sizes, 1000)
        left = packing.swap_search(begun, sizes, 1000)
        squares = [sum(int(sizes[b].sum()) ** 2 for b in bins) for bins in (begun, left)]
        assert squares[1] >= squares[0]
        worse, better = worse + len(begun), better + len(left)
    assert better < worse


def test_a_shard_without_room_for_swaps_ends():
    assert len(packing.swap_search(packing.best_fit(np.full(4096, 1100), 2048), np.full(4096, 1100), 2048)) == 4096


def test_cut_points():
    assert packing.cut_points(1, 8) == [0, 1]
    assert packing.cut_points(8, 8) == [0, 8]
    assert packing.cut_points(9, 8) == [0, 1, 9]
    assert packing.cut_points(24, 8) == [0, 8, 16, 24]


def checked(made, capacity):
    """Every sequence is gapless from 0 and within its capacity; how many there are."""
    held = {}
    for r in made:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in held.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans[:-1], spans[1:], strict=True))
        assert sum(spans[-1]) <= capacity
    return len(held)


def brute_pieces(docs, capacity):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    out = []
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = list(range(len(ids), 0, -capacity))[::-1]
        for k, (a, b) in enumerate(zip([0, *cuts[:-1]], cuts, strict=True)):
            out.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return Counter(out)


def test_op11_packs_the_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    made = queries.op11_best_fit_packing(spark, SMALL).collect()
    pieces = brute_pieces([(r.doc_id, r.text) for r in docs.collect()], 2048)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in made) == pieces
    fewest = packing.fewest_bins(np.array([p[3] for p in pieces.elements()]), 2048)
    assert checked(made, 2048) <= fewest + 1


def test_packing_in_many_shards_and_levels(spark):
    rng = random.Random(3)
    texts = [None, "", "", "<|endoftext|> a", "long " * 700] + ["word " * rng.randint(1, 30) for _ in range(600)] + ["same copy"] * 300
    docs = [(None if i % 50 == 0 else 7 if i > 600 else i, t) for i, t in enumerate(texts)]  # a null id, and one id for a third of all
    df = rows_of(spark, [(i, t, "en", None, None) for i, t in docs]).withColumnRenamed("n_chars", "length")  # a name that pieces have
    made = packing.pack_sequences(packing.token_pieces(df, BPE, 64), 64, shard=50).collect()
    pieces = brute_pieces(docs, 64)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in made) == pieces
    lengths = np.array([p[3] for p in pieces.elements()])
    assert checked(made, 64) <= packing.fewest_bins(lengths, 64) * 1.02 + 2


def test_packing_of_nothing_and_of_wrong_lengths(spark):
    assert packing.pack_sequences(packing.token_pieces(rows_of(spark, []), BPE)).count() == 0
    wrong = spark.createDataFrame([(1, 0, 0, 65, 1)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    with pytest.raises(ValueError, match="no length"):
        packing.pack_sequences(wrong, 64)


# ------------------------------------------------------------------ divergence


def brute_divergence(docs, least=10, top=10):
    terms, df, groups = {}, {}, {}
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups.setdefault(lang, {}).setdefault(source, Counter()).update(found)
        df.setdefault(lang, Counter()).update(set(found))
    out = []
    for lang, sources in groups.items():
        terms = [t for t, n in df[lang].items() if n >= least]
        v = len(terms)

        def shares(counts, terms=terms, v=v):
            n = sum(counts[t] for t in terms)
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * v) for t in terms}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        p = {s: shares(c) for s, c in sources.items()}
        q = shares(sum(sources.values(), Counter()))
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in terms), o) for o in sources if o != s]
            own = [(f(p[s][t], q[t]), t) for t in terms if sources[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", own, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def collected(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_op12_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("text", "lang", "source").collect()
    assert collected(queries.op12_source_divergence(spark, SMALL)) == brute_divergence(docs)


@pytest.mark.parametrize(("block", "chunk"), [(4096, 64), (3, 64), (5, 2), (4096, 1)])
def test_tiles_and_chunks_do_not_change_results(spark, block, chunk):
    """Several chunks of groups, terms that whole chunks lack, nulls, ties, repeats, a source and a language without terms."""
    rng = random.Random(1)
    words = [*"ab cd ef gh ij kl mn op qr".split(), "Ünï", "日本", "É", "ZZ", "zz", "a1b"]
    docs = [(i, " ".join(rng.choices(words[: 3 + i % 12], k=rng.randint(0, 9))) + "x-y_z", rng.choice(["en", "de", None, ""]), f"s{i % 5}") for i in range(200)]
    docs += [(None, None, "fr", "s1"), (1, "", "fr", None), (2, "12 34", "fr", "s2"), (3, "only once here", "it", "lone")] + [(9, "Tie tie TIE eit", "tied", "a")] * 12
    docs += [(9, "eit tie", "tied", "b")] * 11
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").withColumn("term", F.lit(1)).withColumn("count", F.lit("x"))
    made = collected(divergence.source_divergence(df, least=3, top=4, block=block, chunk=chunk))
    assert made == brute_divergence([d[1:] for d in docs], least=3, top=4)


def test_divergence_of_nothing(spark):
    assert divergence.source_divergence(rows_of(spark, [])).count() == 0


def test_shares_are_exact_where_products_pass_64_bits():
    total = 8_999_999_999_999_989
    counts = np.array([0, 1, 12_345_678_901_234, total - 1, total], np.int64)
    assert divergence.share(counts, total).tolist() == [1 + 10**9 * int(c) // total for c in counts]


def test_terms_do_not_cross_texts():
    texts = ["Ab", "cD é", "", "1", "ß", "x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    terms, row = divergence.terms_of(data, offsets)
    assert (terms.to_pylist(), row.tolist()) == (["ab", "cd", "é", "ß", "x"], [0, 1, 1, 4, 5])


# ------------------------------------------------------------------ fill in the middle


def brute_middle(doc_id, text, seed=42, rate=50, spm=80):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


PARTS = [" ", "\t", "\n\n", "\x0b", "\x0c\r", "\x1c", "\x85", "　", "é", "日本", "🤦", "word", "<", "P>", "<S", ">", "<M>", "<P>", "​", "\x00"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join))
def test_scan_finds_the_units_of_the_pattern(text):
    ends, at = [], 0
    for unit in re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text):
        at += len(unit)
        ends.append(at)
    white, spelt = fill_in_middle.scan(text)
    assert fill_in_middle.unit_ends(white, len(text)).tolist() == ends
    assert spelt == any(s in text for s in fill_in_middle.SENTINELS)


def test_fill_in_middle_equals_brute_force_and_round_trips(spark):
    rng = random.Random(2)
    texts = [None, "", " ", "<P>", "a <S b", "a<", "word " * 300_000]
    texts += ["".join(rng.choices(PARTS[:-4] + PARTS[-2:], k=rng.randint(1, 40))) for _ in range(400)]
    docs = [(i if i % 40 else None, t, "en", None, None) for i, t in enumerate(texts)] + [(5, "one two three", "en", None, None)] * 3
    df = rows_of(spark, docs).withColumnRenamed("n_chars", "output").withColumn("kept", F.lit(1)).withColumn("h0", F.lit("x"))
    made = fill_in_middle.fill_in_middle(df, carry=("lang",)).withColumn("again", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
    expected = Counter(brute_middle(d[0], d[1]) for d in docs)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made) == expected
    assert Counter(r.again for r in made) == Counter(d[1] or "" for d in docs)
    assert {r.form for r in made} == {"plain", "psm", "spm"} and {r.lang for r in made} == {"en"}


def test_fill_in_middle_with_other_sentinels_rates_and_names(spark):
    marks = ("<|pre|>", "<|suf|>", "<|mid|>")
    df = rows_of(spark, [(i, f"a b <P> {i} c", "en", "s", 1) for i in range(50)])
    made = fill_in_middle.fill_in_middle(df, rate=100, spm=0, sentinels=marks)
    back = made.select("form", fill_in_middle.restored(F.col("output"), F.col("form"), marks).alias("text")).collect()
    assert {r.form for r in back} == {"psm"} and sorted(r.text for r in back) == sorted(f"a b <P> {i} c" for i in range(50))
    with pytest.raises(ValueError, match="these names"):
        fill_in_middle.fill_in_middle(df.withColumn("n", F.lit(1)), carry=("n",))
    assert fill_in_middle.fill_in_middle(rows_of(spark, [])).count() == 0


# ------------------------------------------------------------------ names of inputs


def names_inside() -> list[str]:
    """Every name that an operator of the subpackage or the pipeline gives a column."""
    import pathlib

    import tallyfield.llm

    folder = pathlib.Path(tallyfield.llm.__file__).parent
    source = "\n".join(p.read_text() for p in [*folder.glob("*.py"), folder.parent.parent / "corpus_pipeline.py"])
    found = re.findall(r"""(?:alias|withColumn|withColumnRenamed)\(["'](\w+)["']""", source) + re.findall(r"""["'](\w+)["']:""", source)
    found += re.findall(r"\b(\w+) (?:long|int|string|double|boolean|binary|array<)", source) + re.findall(r"""as (\w+)["']""", source)
    return sorted({n for n in found if n not in DOC.replace(",", "").split()})


def test_no_stage_confuses_its_own_names_with_columns_of_the_input(spark):
    import corpus_pipeline

    inside = names_inside()
    assert {"rep", "h", "whole", "_whole", "copies", "filled", "k1", "_text"} <= set(inside)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    more = docs.select("*", *[F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")).alias(n) for n in inside])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, more, SMALL)
        assert made.columns == more.columns, name
        rows = made.select("doc_id", *inside).collect()
        assert rows and all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in inside), name
        plain = stage(spark, docs, SMALL).select("doc_id").collect()
        assert sorted(r.doc_id for r in plain) == sorted(r.doc_id for r in rows), name
    last = corpus_pipeline.STAGES[-1][1]
    assert Counter(last(spark, more, SMALL).collect()) == Counter(last(spark, docs, SMALL).collect())

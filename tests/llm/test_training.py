"""The training-data operators against brute force, exact round trips and held-out accuracy, and their edge cases."""

import collections
import math
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallyfield.llm import queries, sql, vectors
from tallyfield.llm.classifiers import fit_nnpu, quality, toxicity
from tallyfield.llm.html_extract import extract_pages, main_text
from tallyfield.llm.language_model import expectation_maximisation, score_texts
from tallyfield.llm.mixing import mix_sources
from tallyfield.llm.ngram_join import drop_near_copies, ngram_jaccard_join, plan_bands
from tallyfield.llm.segmentation import Vocabulary, decode_ids, sample_batch, sample_segmentations
from tallyfield.llm.token_file import decode, expansions, read_token_file, repair, token_path, write_token_file
from tallyfield.llm.vectors import near_duplicate_vectors, nearest_vectors

SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
PIECES, BPE = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "one", "one two three four five", "one two three four five", "Zoë’s\tnaïve　café \U0001f600\n\n x", "a" * 3000, "w " * 9000, "it's we'll <|endoftext|>"]


def documents(spark, texts, first=0):
    made = [(first + i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(made, DOC)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ------------------------------------------------------------------ vectors


def brute_components(n, pairs):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_near_vectors_equal_brute_force_at_the_threshold(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((400, 16))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = rng.standard_normal((400, 16))
    other -= (other * base).sum(1, keepdims=True) * base
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = rng.uniform(0.9, 0.96, (400, 1))
    x = np.vstack([base, cosine * base + np.sqrt(1 - cosine**2) * other]).astype(np.float32)
    label = np.tile(np.arange(400) % 3, 2)
    rows = [(i, x[i].tolist(), int(label[i])) for i in range(800)]
    made = near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), sample=512, block=32).collect()
    d = x.astype(np.float64)
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    linked = (d @ d.T >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(linked, False)
    got = {r.vec_id: r for r in made}
    assert len(got) == 800
    assert [got[i].n_links for i in range(800)] == linked.sum(1).tolist()
    comp = brute_components(800, np.argwhere(np.triu(linked)).tolist())
    assert [got[i].component_id for i in range(800)] == comp


def test_near_vectors_of_many_cells_equal_brute_force(spark):
    """Clustered vectors keep many cells; groups straddle cells, and one cluster is larger than a block."""
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((12, 8))
    x = centre[np.minimum(rng.integers(0, 24, 1500), 11)] + 0.22 * rng.standard_normal((1500, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sine = float(np.sqrt(1 - 0.93**2))
    centres = vectors.spherical_kmeans(x[:512], 16)
    home, reach = vectors._reach(x, centres, sine)
    assert len(centres) > 1 and 1500 < reach.sum() < 1500 * (len(centres) + 1) / 2
    linked = x @ x.T >= 0.93
    assert all(reach[a, min(home[a], home[b])] and reach[b, min(home[a], home[b])] for a, b in np.argwhere(linked))
    np.fill_diagonal(linked, False)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), sample=512, block=64).collect()}
    assert [got[i].n_links for i in range(1500)] == linked.sum(1).tolist()
    assert [got[i].component_id for i in range(1500)] == brute_components(1500, np.argwhere(np.triu(linked)).tolist())


def test_near_vectors_edges(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [1.0, float("nan")], 1),
            (8, [1.0, None], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 1), (11, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (12, [float("inf"), 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("kept", F.lit("clash"))
    got = sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(df).collect())
    assert len(got) == len(rows)
    assert (1, 3, 1, True) in got and (2, 3, 1, False) in got and got.count((11, 3, 1, False)) == 2
    assert all((i, 0, i, True) in got for i in (3, 4, 5, 6, 7, 8, 9, 10, 12)) and (-1, 0, None, True) in got
    assert near_duplicate_vectors(df.limit(0)).count() == 0


def test_search_recall_and_order(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet").union(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").withColumn("vec_id", F.col("vec_id") + 10_000))
    rows = df.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got = collections.defaultdict(list)
    for r in nearest_vectors(df, F.col("vec_id") % 20 == 0, shard_rows=400).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    hits = []
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -s))[:20]]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 21)) and mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        hits.append(len(set(best) & {m[1] for m in mine}) / 20)
    assert np.mean(hits) >= 0.9


def test_search_edges(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [5.0, 0.0], 1), (2, [1.0, 1.0], 1), (3, None, 1), (20, [0.0, 0.0], 1), (None, [1.0, 0.0], 1), (4, [5.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = nearest_vectors(df, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 1, 5.0), (0, 2, 4, 5.0), (0, 3, 2, 1.0)]
    assert nearest_vectors(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# ------------------------------------------------------------------ mixing


def test_mix_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = sorted(con.execute(f"SELECT doc_id, size, source_size, target, taken, copies FROM ({sql.OP3_MIX_SOURCES})").fetchall())
    got = sorted(tuple(r) for r in queries.op3_mix_sources(spark, SMALL).select("doc_id", "size", "source_size", "target", "taken", "copies").collect())
    assert got == want


def test_mix_targets_and_edges(spark):
    texts = [f"{'w ' * (i % 7)}" for i in range(60)] + [None, "", "x" * 50]
    df = documents(spark, texts).withColumn("target", F.lit("clash"))
    rows = mix_sources(df).collect()
    assert len(rows) == len(texts)
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        assert r.size == len(words(r.text)) and r.taken <= 2 * r.size and r.taken == r.copies * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(target[s] <= 2 * sizes[s] + 1e-9 and abs(taken[s] - target[s]) <= 4 for s in sizes)
    assert math.isclose(sum(target.values()), 1.5 * sum(sizes.values()))
    assert sorted(map(str, mix_sources(df).collect())) == sorted(map(str, rows))
    assert mix_sources(df.limit(0)).count() == 0
    assert {r.taken for r in mix_sources(documents(spark, [None, ""])).collect()} == {0}


# ------------------------------------------------------------------ n-gram join


def brute_join(texts, n=5, similarity=0.8):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9]
    links = collections.Counter(x for p in pairs for x in p)
    return links, brute_components(len(sets), pairs)


def test_ngram_join_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(vocabulary, int(rng.integers(1, 90)))) for _ in range(60)]
    for i in range(60):  # copies with changes around the threshold, some in chains, and exact copies
        w = words(texts[int(rng.integers(0, len(texts)))])
        for _ in range(i % 4):
            w[int(rng.integers(0, len(w)))] = "changed"
        texts.append(" ".join(w))
    texts += ODD
    links, comp = brute_join(texts)
    got = {r.doc_id: r for r in ngram_jaccard_join(documents(spark, texts), chunk=8).collect()}
    assert len(got) == len(texts)
    assert {i: r.n_links for i, r in got.items()} == {i: links[i] for i in range(len(texts))}
    assert [got[i].component_id for i in range(len(texts))] == comp
    assert all(r.kept == (r.component_id == r.doc_id) for r in got.values())
    assert sum(links.values()) > 50


def test_ngram_join_edges(spark):
    df = documents(spark, ["a b c d e f"] * 3).union(documents(spark, ["a b c d e f", "q"]))
    assert sorted((r.doc_id, r.n_links) for r in ngram_jaccard_join(df).collect()) == [(0, 3), (0, 3), (1, 0), (1, 3), (2, 3)]
    nulls = documents(spark, ["a b c d e f", "a b c d e f"]).withColumn("doc_id", F.when(F.col("doc_id") == 1, 7))
    assert sorted(r.n_links for r in ngram_jaccard_join(nulls).collect()) == [1, 1]
    assert drop_near_copies(df).columns == df.columns and drop_near_copies(df).count() == 2
    assert ngram_jaccard_join(df.limit(0)).count() == 0
    bands, rows = plan_bands(0.8, 0.99999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.99999


# ------------------------------------------------------------------ classifiers


def labelled(spark, n=600):
    rng = np.random.default_rng(9)
    plain = [f"word{i}" for i in range(120)]
    texts, rows = [], []
    for i in range(n):
        w = list(rng.choice(plain, int(rng.integers(5, 60))))
        toxic, junk = i % 5 == 0, i % 7 == 0
        if toxic:
            w.insert(int(rng.integers(0, len(w))), str(rng.choice(["vilescum", "nastyfool"])))
        text = " ".join(w)
        texts.append("!!".join(w).upper() + "!!" if junk else text)
        rows.append((i, 0 if junk else 1, int(toxic)))
    return documents(spark, texts), spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity_and_quality_learn(spark):
    docs, labels = labelled(spark)
    for model, column, fold, held in ((toxicity, "toxic", 5, 0), (quality, "quality", 4, 2)):
        rows = model(docs, labels).join(labels, "doc_id").collect()
        assert len(rows) == 600 and all(0 <= r.score <= 1 for r in rows)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold == held) for r in rows)
        assert np.mean([r.predicted == r[column] for r in rows if r.held_out]) > 0.9
        assert sorted(map(str, model(docs, labels).select("doc_id", "score").collect())) == sorted(map(str, model(docs, labels).select("doc_id", "score").collect()))


def test_classifiers_never_see_held_out_labels(spark):
    docs, labels = labelled(spark, 200)
    for model, column, fold, held in ((toxicity, "toxic", 5, 0), (quality, "quality", 4, 2)):
        out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(fold)) == held
        flipped = labels.withColumn(column, F.when(out, 1 - F.col(column)).otherwise(F.col(column)))
        scores = lambda lab: sorted((r.doc_id, r.score) for r in model(docs, lab).collect())  # noqa: B023, E731
        assert scores(labels) == scores(flipped)


def test_classifier_edges(spark):
    docs = documents(spark, ODD).union(documents(spark, ODD)).withColumn("score", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(i, i % 2 if i != 3 else None, 1) for i in range(6)] + [(None, 1, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    for model in (toxicity, quality):
        for labels in (none, some):
            rows = model(docs, labels).collect()
            assert len(rows) == 2 * len(ODD) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
        assert model(docs.limit(0), some).count() == 0
    assert {r.score for r in quality(docs, none).collect()} == {0.5}


def test_nnpu_separates():
    rows, features = np.repeat(np.arange(100), 2), np.tile([0, 1], 100)
    features[: 2 * 20 : 2] = 2  # the first 20 rows have feature 2 instead of 0
    positive = np.arange(100) < 10
    w, b = fit_nnpu(rows, features, positive, np.ones(100, bool), 3, 0.2)
    g = np.bincount(rows, w[features], 100) + b
    assert g[:20].min() > 0 > g[20:].max()


# ------------------------------------------------------------------ html


def test_main_text():
    page = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><header>Top of the site</header><nav><a href=x>Home</a></nav>
    <div class="cookie-notice">We use cookies and the like for you.</div><article><h1>A &amp; B</h1><p>The first of the\n paragraphs <b>is</b> in <i>the</i>re.<br>Next<p>Short.
    <form>Search the site</form></article><aside>More of the same</aside><section id="comments"><p>I think that this is the best of all the posts in the world.</p></section>
    <footer>&copy; us</footer></body></html>"""
    assert main_text(page) == "A & B The first of the paragraphs is in there. Next Short."
    plain = "<div><p>" + "The cat sat on the mat and it was happy with all of the things that it had in the house. " * 3 + "</p><p>Yes.</p></div><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul>"
    assert main_text(plain).endswith("in the house. Yes.")
    assert main_text(None) == main_text("") == main_text("<p>") == main_text("<!-- x") == ""


def test_main_text_keeps_what_a_value_or_class_word_only_mentions():
    prose = "The cat sat on the mat and it was happy with all of the things that it had in the house. " * 3
    prose = prose.strip()
    for attributes in ("href='/the-hidden-valley.html'", 'title="a hidden gem"', 'data-hidden="false"', 'href="/story?id=notice-12"', "href=/x?role=form"):
        assert main_text(f"<article><p {attributes}>{prose}</p><p>One <a {attributes}>two</a>.</p></article>") == f"{prose} One two."
    for word in ("layout with-sidebar", "content has-banner"):
        assert main_text(f'<div class="{word}"><p>Menu of all.</p><article><h1>A</h1><p>{prose}</p></article></div>') == f"A {prose}"
        assert main_text(f'<div class="{word}"><p>{prose}</p></div>') == prose
        assert main_text(f'<article><h1>A</h1><div class="{word}"><h2>B</h2><p>{prose}</p></div></article>') == f"A B {prose}"
    assert main_text(f'<article class="has-comments"><p>{prose}</p></article>') == prose
    for gone in ("<p hidden>x</p>", "<p HIDDEN=''>x</p>", "<div aria-hidden=true>x</div>", '<p style="display: none">x</p>', "<div role='form'>x</div>", '<div class="share">Share this.</div>'):
        assert main_text(f"<article><p>{prose}</p>{gone}</article>") == prose


def test_extract_pages(spark):
    df = spark.read.parquet(f"{SMALL}/pages.parquet").withColumn("text", F.lit(1))
    for r in extract_pages(df).collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        import html

        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))).split())
        assert r.text == want and r.n_chars == len(want)
    odd = spark.createDataFrame([(1, None), (2, ""), (2, "")], "page_id long, html string")
    assert [(r.text, r.n_chars) for r in extract_pages(odd).collect()] == [("", 0)] * 3
    assert extract_pages(odd.limit(0)).count() == 0


# ------------------------------------------------------------------ token file


def test_token_file_equals_the_library(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    texts = [(r.doc_id, r.text) for r in rows] + [(100_000 - i, t) for i, t in enumerate(ODD)]
    path = token_path(spark)
    write_token_file(spark.createDataFrame(texts, "doc_id long, text string"), path, BPE, shard_bytes=50_000)
    got, start = read_token_file(spark.read.parquet(path)).orderBy("doc_id").collect(), 0
    for r, (doc_id, text) in zip(got, sorted(texts, key=lambda x: x[0]), strict=True):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_file_edges(spark):
    path = token_path(spark)
    write_token_file(spark.createDataFrame([(None, "x"), (1, "y"), (1, "y"), (None, None)], "doc_id long, text string"), path, BPE)
    got = read_token_file(spark.read.parquet(path)).orderBy("start").collect()
    assert [(r.doc_id, r.start) for r in got][2:] == [(1, 3), (1, 5)] and {r.doc_id for r in got[:2]} == {None}
    empty = token_path(spark)
    write_token_file(spark.createDataFrame([], "doc_id long, text string"), empty, BPE)
    assert read_token_file(spark.read.parquet(empty)).count() == 0


def test_op7_gives_added_tokens_their_ids(spark, tmp_path):
    """The registered query against a tokenizer left as loaded."""
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [f"hello {end} world", end, "<|endof", "text|>", f"a\n {end}\n\n b {end}{end} ", f"it's{end}'s  {end}x", f"é{end}<|endoftext |>", "", None, f"  {end}  "]
    tokenizer = Tokenizer.from_file(BPE)
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got, start = queries.queries()["op7_token_file"](spark, str(tmp_path)).orderBy("doc_id").collect(), 0
    for r, text in zip(got, texts, strict=True):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_repair_leaves_no_frequent_pair():
    rng = np.random.default_rng(7)
    passage = rng.integers(100, 40_000, 300)  # long and repeated in many documents
    texts = [np.concatenate([rng.integers(0, 300, 400), passage, np.full(rng.integers(0, 60), 7), [0]]) for _ in range(60)]
    ids, docs = np.concatenate(texts).astype(np.uint32), np.cumsum([0, *map(len, texts)])
    rules, sequence, begins = repair(ids, docs, 50_257)
    written, bounds = expansions(rules, 50_257)
    tally = collections.Counter()
    for i, (lo, hi) in enumerate(zip(begins[:-1], begins[1:], strict=True)):
        part = sequence[lo:hi].astype(np.int64)
        assert (decode(part, written, bounds, 50_257) == texts[i]).all()
        part, last = part.tolist(), None
        for at, pair in enumerate(zip(part, part[1:], strict=False)):
            if pair[0] != pair[1] or last != (at - 1, pair):  # within a run every second pair
                tally[pair] += 1
                last = (at, pair)
            else:
                last = None
    assert max(tally.values()) < 24
    assert np.diff(bounds).max() >= 300 and len(np.unique(rules, axis=0)) == len(rules)


# ------------------------------------------------------------------ language model


def test_language_model_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").union(documents(spark, ODD, 50_000))
    tokens = {r.doc_id: words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")) + ["\0end"] for r in docs.collect()}
    fold = {d: zlib.crc32(str(d).encode()) % 10 for d in tokens}
    count = collections.Counter(w for d in tokens if fold[d] for w in tokens[d])
    total, vocabulary = sum(count.values()), len(count)
    got = {r.doc_id: r for r in score_texts(docs).collect()}
    assert set(got) == set(tokens)
    for d, r in got.items():
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (vocabulary + 1))) for w in tokens[d])
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold[d] == 0, len(tokens[d]), sum(count[w] > 0 for w in tokens[d]), total)
        assert r.score < 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_edges(spark):
    df = documents(spark, ["a b", "a b", None, ""]).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    rows = score_texts(df.union(df)).collect()
    assert len(rows) == 8 and all(r.held_out for r in rows if r.doc_id is None)
    assert score_texts(df.limit(0)).count() == 0
    assert np.isfinite([r.score for r in score_texts(documents(spark, ["a"]), order=3).collect()]).all()
    weights = expectation_maximisation(np.array([0, 0]), np.array([[0.1, 0.0], [0.1, 0.9]]), np.array([1.0, 3.0]))
    assert math.isclose(weights[0].sum(), 1) and 0.5 < weights[0, 1] < 0.9


# ------------------------------------------------------------------ segmentation


def segmentations(vocab, text):
    pieces = {}
    for length, (keys, ids) in vocab.pieces.items():
        for i in ids:
            pieces[vocab.bytes[vocab.bounds[i] : vocab.bounds[i + 1]].tobytes().decode()] = int(i)
    out = []

    def go(rest, ids, logp):
        if not rest:
            out.append((tuple(ids), logp))
        for n in range(1, len(rest) + 1):
            if rest[:n] in pieces:
                go(rest[n:], [*ids, pieces[rest[:n]]], logp + vocab.logp[pieces[rest[:n]]])

    go(" " + text, [], 0.0)
    total = np.logaddexp.reduce([lp for _, lp in out])
    return {ids: math.exp(lp - total) for ids, lp in out}


def test_samples_follow_the_exact_distribution():
    vocab, text, n = Vocabulary(PIECES), "in the", 30_000
    truth = segmentations(vocab, text)
    data = np.frombuffer((text * n).encode(), np.uint8)
    keys = np.random.default_rng(1).integers(0, 2**63, n).astype(np.uint64)
    lattice, out, _ = sample_batch(vocab, data, np.arange(n + 1) * len(text), keys, 2)
    seen = [collections.Counter(), collections.Counter()]
    both = [{}, {}]
    for s, (live, edges, bound, logp, _) in enumerate(out):
        for r in live:
            ids = tuple(lattice.id[edges[bound[r] : bound[r + 1]]].tolist())
            seen[s][ids] += 1
            both[s][r] = ids
            assert math.isclose(math.exp(logp[r]), truth[ids], rel_tol=1e-6)
    assert all(both[0][r] != both[1][r] for r in both[1])
    for ids, p in truth.items():
        second = sum(q * p / (1 - q) for other, q in truth.items() if other != ids)
        for s, want in enumerate((p, second)):
            assert abs(seen[s][ids] / n - want) < 5 * math.sqrt(want * (1 - want) / n) + 1e-4


@pytest.mark.parametrize("text", ["a);\r\nb", "}\r\r\n\tx", "\r", ";\r {\r"])
def test_lattices_of_line_ends_hold_every_segmentation(text):
    """Carriage returns are in pieces of several characters; bytes stand for characters without a piece."""
    vocab = Vocabulary(PIECES)
    by_text = {vocab.bytes[vocab.bounds[i] : vocab.bounds[i + 1]].tobytes().decode(): int(i) for _, ids in vocab.pieces.values() for i in ids}

    def go(rest, ids, logp):
        if not rest:
            return [(ids, logp)]
        out = []
        for n in range(1, len(rest) + 1):
            if rest[:n] in by_text:
                i = by_text[rest[:n]]
                out += go(rest[n:], (*ids, i), logp + vocab.logp[i])
            elif n == 1:
                raw = rest[0].encode()
                out += go(rest[1:], (*ids, -1 - ord(rest[0])), logp + len(raw) * vocab.logp[vocab.byte_ids[0]])
        return out

    ways = go(" " + text, (), 0.0)
    total = np.logaddexp.reduce([logp for _, logp in ways])
    truth = {ids: logp - total for ids, logp in ways}
    data = np.frombuffer(text.encode(), np.uint8)
    lattice, out, _ = sample_batch(vocab, data, np.array([0, len(data)]), np.array([5], np.uint64), len(truth))
    drawn = {tuple(lattice.id[edges].tolist()): logp[0] for _, edges, _, logp, _ in out}
    assert drawn.keys() == truth.keys()
    assert all(math.isclose(drawn[ids], truth[ids], abs_tol=1e-6) for ids in truth)


def test_remembered_units_change_no_sample():
    """Units kept from earlier batches, or forgotten in between, give the samples of a fresh lattice."""
    texts = ["the cat sat on the mat", "a cat, a mat and the café", "x" * 400, "the cat sat again on a mat"]
    results = []
    for most in (10, 60, 1 << 20, None):
        vocab, made = Vocabulary(PIECES), []
        for i, text in enumerate(texts * 2):
            if most is None:
                vocab.lattice.forget()
            else:
                vocab.lattice.most = most
            data = np.frombuffer(text.encode(), np.uint8)
            lattice, out, _ = sample_batch(vocab, data, np.array([0, len(data)]), np.array([i], np.uint64), 3)
            made += [(lattice.id[edges].tolist(), logp.tolist(), perturbed.tolist()) for _, edges, _, logp, perturbed in out]
        results.append(made)
    assert results[0] == results[1] == results[2] == results[3]


def test_segmentations_round_trip_and_edges(spark):
    df = documents(spark, ODD).withColumn("ids", F.lit("clash"))
    rows = decode_ids(sample_segmentations(df, PIECES, k=3), PIECES, to="again").collect()
    by = collections.defaultdict(list)
    for r in rows:
        assert r.decoded == r.again == (r.text or "") and r.log_prob <= 1e-9 and r.log_inclusion <= 1e-9
        by[r.doc_id].append((r.sample, tuple(r.ids), r.perturbed))
    for i, t in enumerate(ODD):
        found = sorted(by[i])
        assert len({f[1] for f in found}) == len(found) >= 1
        assert [f[2] for f in found] == sorted((f[2] for f in found), reverse=True)
        assert len(found) == 1 if not t else True
    again = sample_segmentations(df.repartition(3), PIECES, k=3).select("doc_id", "sample", "ids").collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in sample_segmentations(df, PIECES, k=3).select("doc_id", "sample", "ids").collect())
    assert sample_segmentations(df.limit(0), PIECES).count() == 0


# ------------------------------------------------------------------ pipeline


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    clean = corpus_pipeline.reject_toxic(spark, docs, SMALL).cache()
    predicted = {r.doc_id for r in toxicity(docs, labels).where("predicted = 0").collect()}
    assert {r.doc_id for r in clean.collect()} == predicted
    good = corpus_pipeline.reject_low_quality(spark, clean, SMALL).cache()
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality(clean, labels).where("predicted = 1").collect()}
    rows = sorted(((r.doc_id, r.text) for r in good.collect()))
    _, comp = brute_join([t for _, t in rows])
    single = corpus_pipeline.reject_near_copies(spark, good, SMALL).cache()
    assert sorted(r.doc_id for r in single.collect()) == sorted(rows[c][0] for c in set(comp))
    mixed = corpus_pipeline.mix(spark, single, SMALL).cache()
    copies = {r.doc_id: r.copies for r in mix_sources(single).collect()}
    assert collections.Counter(r.doc_id for r in mixed.collect()) == collections.Counter({d: c for d, c in copies.items() if c})
    assert clean.columns == good.columns == single.columns == mixed.columns == docs.columns
    encoded = corpus_pipeline.run(spark, SMALL).collect()
    assert len(encoded) == 2 * mixed.count() and all(r.round_trip for r in encoded)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_run_on_the_small_tables(spark, name):
    assert queries.queries()[name](spark, SMALL).count() > 0

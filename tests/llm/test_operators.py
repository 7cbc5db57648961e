"""Edge cases of the training-data operators, and brute-force versions on small tables."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from unisono.llm import common, decontamination, hilbert_sharding, html_extraction, jaccard_join, language_id, line_dedup, packing, suffix_dedup, topk_search, toxicity

EDGE = [(0, None, None, None), (1, "", "en", "s0"), (2, " \n\t", "en", "s0"), (3, "one two three four five six seven", "en", "s1"), (4, "one two three four five six seven", None, "s2"), (5, "x" * 5000, "en", "s0")]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    words = ["ab", "cd", "ef", "gh", "ij", "kl", "mn", "op", "qr", "st", "uv", "wx"]
    rows = list(EDGE)
    for i in range(10, 60):
        t = "\n".join(" ".join(rng.choice(words) + rng.choice(words) for _ in range(rng.randint(5, 30))) for _ in range(3))
        rows.append((i, t, "en", f"s{i % 7}"))
    for i in range(60, 75):
        w = rows[i - 50][1].split(" ")
        w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w) if i % 2 else rows[i - 50][1], "en", f"s{i % 7}"))
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, n long").repartition(3)


def _texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def test_hilbert_curve_is_continuous():
    cells = sorted((hilbert_sharding.hilbert_index((x, y, z), 2), (x, y, z)) for x in range(4) for y in range(4) for z in range(4))
    assert [i for i, _ in cells] == list(range(64))
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for (_, p), (_, q) in zip(cells, cells[1:], strict=False))


def test_shards(docs):
    got = hilbert_sharding.shard_documents(docs, 7).toPandas()
    n = got.groupby("shard").size()
    assert len(got) == docs.count() and n.max() - n.min() <= 1
    assert (got.groupby("shard").slot.max() + 1 == n).all()
    assert hilbert_sharding.shard_documents(docs.where("false"), 7).count() == 0


@pytest.mark.parametrize("heavy", [1, 50_000])
def test_equal_texts_lie_side_by_side(spark, heavy, monkeypatch):
    """Places equal a sort by hand; the cuts part one group each at most, though copies come from all sources."""
    monkeypatch.setattr(hilbert_sharding, "HEAVY", heavy)
    rows = [(i, f"text {i % 9 if i % 3 else i}" if i % 11 else None, ["en", "de", None][i % 3], f"https://example.test/{i % 13}") for i in range(200)]
    got = hilbert_sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5), 6).toPandas()
    order = got.sort_values(["shard", "slot"])
    assert list(order.curve) == sorted(order.curve) and len(order) == 200
    assert got.groupby("text_crc32").curve.nunique().max() == 1
    assert (got.groupby("text_crc32").shard.nunique() - 1).sum() <= 5
    assert got.source_bucket.nunique() > 6  # values that begin alike still part


def test_string_limits_equal_quantiles_by_hand(spark):
    values = [f"https://example.test/{i * i % 50:02}" for i in range(400)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v string").repartition(3)
    steps = [0.25, 0.5, 0.75]
    assert hilbert_sharding.string_limits(df, F.col("v"), steps) == [sorted(values)[int(len(values) * q) - 1] for q in steps]
    assert hilbert_sharding.string_limits(df.where("v is null"), F.col("v"), steps) == []


def test_tokens_are_the_librarys():
    t = packing.tokenizer(packing.vocabulary_path())
    for s in ["", "It's 12 o'clock, ÉTÉ ß!", "a<|endoftext|>b", "Σας İ ²½   x", "é '\tll 我的"]:
        assert t.encode(s).tolist() == t.full.encode(s, add_special_tokens=False).ids


def test_packing_round_trip(docs):
    rows = packing.pack_documents(docs, packing.vocabulary_path(), capacity=64).collect()
    tok = packing.tokenizer(packing.vocabulary_path())
    texts = _texts(docs)
    for i, t in texts.items():
        ids = np.append(tok.encode(t or ""), np.uint32(2))
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert [r.start for r in mine] == np.cumsum([0] + [r.length for r in mine])[:-1].tolist() and sum(r.length for r in mine) == len(ids)
        assert all(zlib.crc32(ids[r.start : r.start + r.length].astype("<u4")) == r.ids_crc32 and r.doc_tokens == len(ids) for r in mine)
    seqs = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert r.offset == seqs.get(r.sequence_id, 0)
        seqs[r.sequence_id] = r.offset + r.length
    assert max(seqs.values()) <= 64


def test_packer_keeps_all_limits():
    rng = random.Random(0)
    packer = packing.Packer(100, 5, 40, cut=False, pool=20)
    pieces = [packing.Piece(i, 0, n := rng.randint(1, 60), rng.randint(0, min(n, 40))) for i in range(200)]
    out = list(packing.pack(iter(pieces), packer))
    assert sorted(p.key for s in out for p in s) == list(range(200))
    assert all(sum(p.tokens for p in s) <= 100 and len(s) <= 5 and sum(p.loss for p in s) <= 40 for s in out)


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_top_k(spark, limit, monkeypatch):
    monkeypatch.setattr(topk_search, "BROADCAST_BYTES", limit)
    rng = np.random.default_rng(0)
    v = rng.normal(0, 0.2, (90, 8))
    rows = [(i, v[i].tolist()) for i in range(90)] + [(90, None), (91, [float("nan")] * 8), (92, []), (93, [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk_search.top_k(df.where("vec_id % 20 = 0"), df, "vec_id", "embedding", k=5, block=7).collect()}
    e = np.floor(64 * v).astype(int)
    for q in range(0, 90, 20):
        best = sorted(((int(-(e[q] @ e[i])), i) for i in range(90) if i != q))[:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, -s) for s, i in best]


def _components(docs, shingle, percent):
    """Every pair compared."""
    sets = {i: set(jaccard_join.tokens_of(t, shingle).tolist()) for i, t in _texts(docs).items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_jaccard_components(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, 3, 80).collect()}
    assert got == _components(docs, 3, 80)


@pytest.mark.parametrize("rounds", [0, 2])
def test_jaccard_components_of_texts_with_common_passages(spark, rounds, monkeypatch):
    """Near copies among texts that share a passage of all lengths; frequent signatures, several parts of a leader, and blocks."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", 2)
    monkeypatch.setattr(jaccard_join, "MEMBERS", 3)
    monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 5)
    monkeypatch.setattr(jaccard_join, "LEADER_ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 7)
    rng = random.Random(8)
    common = [f"c{i}" for i in range(60)]
    rows = []
    for i in range(120):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([4, 10, 30]))]
        at = rng.randrange(len(own))
        rows.append((i, " ".join(own[:at] + common[: rng.choice([10, 30, 60])] + own[at:])))
    for i in range(120, 200):
        words = rng.choice(rows)[1].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = _components(df, 3, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, 3, 80).collect()} == want
    assert len({c for _, c in want.values()}) < 150


def test_jaccard_signatures_find_all_links():
    rng = np.random.default_rng(1)
    for percent in (80, 90):
        for _ in range(400):
            n = int(rng.integers(4, 300))
            a = rng.integers(0, 2**63, n).astype(np.uint64)
            d = (100 - percent) * 2 * n // (100 + percent)
            cut = int(rng.integers(0, d // 2 + 1))
            b = np.concatenate([a[cut:], rng.integers(0, 2**63, max(0, int(rng.integers(0, d + 1)) - cut)).astype(np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if both and 100 * both >= percent * (len(a) + len(b) - both) and len(a) + len(b) > 2 * both:
                assert len(np.intersect1d(jaccard_join.signatures(a, percent), jaccard_join.signatures(b, percent)))


def test_jaccard_signatures_find_all_small_links():
    rng = np.random.default_rng(2)
    for percent in (80, 90):
        for small in range(4, 31):
            for large in range(small, 100 * small // percent + 1):
                for gone in range(3):  # tokens of the smaller set that the larger one lacks
                    if gone + large - small == 0 or 100 * (small - gone) < percent * (large + gone):
                        continue
                    for _ in range(20):
                        t = np.unique(rng.integers(0, 2**63, 2 * large + 8).astype(np.uint64))
                        rng.shuffle(t)
                        a, b = np.sort(t[:small]), np.sort(t[gone : gone + large])
                        assert len(np.intersect1d(jaccard_join.signatures(a, percent), jaccard_join.signatures(b, percent))), (percent, small, large, gone)


def test_jaccard_allocation_has_enough_units():
    for percent in (50, 70, 80, 90):
        for band in range(24):
            plan = jaccard_join.allocation(band, percent)
            most = (100 - percent) * 2 * (plan.high - 1) // (100 + percent)
            assert plan.slack >= 0 and plan.segments + plan.deletions - plan.slack >= most + 1, (percent, plan)


def test_near_copies_of_eight_and_ten_shingles(spark):
    text = "a b c d e f g h i j k l"
    df = spark.createDataFrame([(1, text), (2, text + " m n")], "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, 5, 80).collect()} == {1: (8, 1), 2: (10, 1)}


def _repeats(texts, length):
    count = {}
    for t in texts.values():
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            count[b[i : i + length]] = count.get(b[i : i + length], 0) + 1
    out = {}
    for k, t in texts.items():
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[k] = (len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("group", [2048, 3])
def test_suffix_dedup(docs, group, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(docs, 40, 8).collect()}
    assert got == _repeats(_texts(docs), 40)


@pytest.mark.parametrize("rows", [20_000, -1])
def test_passages_of_400_bytes_and_more_go(spark, rows, monkeypatch):
    """Passages of known bytes in two documents each, with the side tables broadcast and exchanged: those shorter than 400 bytes stay."""
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", rows)
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    own = lambda: " ".join(word() for _ in range(90))
    sizes = [300, 399, 400, 600]
    texts = {}
    for k, n in enumerate(sizes):
        passage = " ".join(word() for _ in range(200))[:n]
        for copy, edge in enumerate("<>"):
            texts[10 * k + copy] = f"{own()} {edge}{passage}{edge}{edge} {own()}"
    texts[99] = own()
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == _repeats(texts, 400)
    assert {i: r[1] for i, r in got.items()} == {10 * k + c: n if n >= 400 else 0 for k, n in enumerate(sizes) for c in (0, 1)} | {99: 0}


def test_loser_tree_merges():
    rng = random.Random(2)
    runs, all_ = [], []
    for _ in range(5):
        s = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(20))
        all_ += s
        lcps, tails = suffix_dedup.front_code(s)
        runs.append(suffix_dedup.Run(lcps, [len(t) for t in tails], b"".join(tails)))
    out = list(suffix_dedup.LoserTree(runs))
    assert [t for _, _, t, _ in out] == sorted(all_)
    assert all(n == suffix_dedup.common_prefix(a, b, 0) for (_, _, a, _), (_, _, b, n) in zip(out, out[1:], strict=False))


def test_line_dedup(spark):
    line = "this line stands on many sites"
    rows = [(i, f"own words of document number {i} come first\n{line}" if i < 6 else line, f"s{i}") for i in range(8)] + [(9, None, "s1"), (10, "", None)]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_words=3, max_share=0.5).collect()}
    assert got[0].text == "own words of document number 0 come first" and got[0].n_removed == 1
    assert got[7].text == line and got[9].text is None and got[9].n_lines == 0 and got[10].n_lines == 1


def _line_queries(spark, tmp_path, rows):
    """Texts after the pipeline's stage, and the hashes that op6 gives for the same table."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    staged = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, df, str(tmp_path)).collect()}
    hashes = {r.doc_id: r.kept_sha256 for r in line_dedup.op6_line_dedup(spark, str(tmp_path)).collect()}
    assert hashes == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in staged.items()}
    return staged


def test_spread_lines_go_whatever_their_share(spark, tmp_path):
    line = "this line stands on many sites"
    got = _line_queries(spark, tmp_path, [(i, f"own words {i}\n{line}" if i < 6 else line, f"s{i}") for i in range(8)] + [(9, None, "s1")])
    assert got == {i: f"own words {i}" if i < 6 else "" for i in range(8)} | {9: None}


def test_short_spread_lines_go(spark, tmp_path):
    got = _line_queries(spark, tmp_path, [(i, f"own words of number {i}\nRead more\n\n全文閲読\nonly {i % 2}", f"s{i}") for i in range(8)])
    assert got == {i: f"own words of number {i}\n\nonly {i % 2}" for i in range(8)}


def test_decontamination(spark):
    item = "The river of the north runs fast in spring.\nIt freezes late in the year."
    rows = [(1, "Before. " + item + " After."), (2, "Something else entirely about rivers."), (3, None), (4, ""), (5, item.upper() + " x" * 3000)]
    items = spark.createDataFrame([(7, item), (8, None), (9, "too short")], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, items).collect()} == {(1, 7), (5, 7)}
    assert {r.doc_id for r in decontamination.drop_leaking(docs, items).collect()} == {2, 3, 4}
    assert decontamination.find_leaks(docs, items.where("false")).count() == 0


def test_decontamination_by_short_items(spark):
    items = spark.createDataFrame([(1, "Who wrote Ulysses?"), (2, "水の化学式は何か"), (3, "全文閲"), (4, "?!"), (5, "ulysses")], "item_id long, text string")
    rows = [(1, "They asked: who wrote ULYSSES, then left."), (2, "who wrote it? Ulysses did"), (3, "問題。水の化学式は何か、答えよ"), (4, "これは全文閲読です"), (5, "水の式"), (6, "nothing")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, items).collect()} == {(1, 1), (1, 5), (2, 5), (3, 2), (4, 3)}
    assert {r.doc_id for r in decontamination.drop_leaking(docs, items).collect()} == {5, 6}


def test_wand_is_exact():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    index = decontamination.Index([(i, " ".join(rng.choice(vocab) for _ in range(12))) for i in range(80)])
    for _ in range(50):
        terms = sorted(rng.sample(range(len(index.vocabulary)), 20))
        exact = {}
        for t in terms:
            for d, s in zip(index.docs[t], index.impacts[t], strict=True):
                exact[d] = exact.get(d, 0) + s
        for limit in (0.2, 0.5):
            assert {d for d, _ in index.search(terms, limit)} == {d for d, s in exact.items() if s >= limit - 1e-9}


def test_language_id(spark):
    rng = random.Random(4)
    kinds = {"aa": "abcde", "zz": "vwxyz"}
    rows = [(i, " ".join("".join(rng.choice(kinds[k]) for _ in range(5)) for _ in range(20)), k) for i, k in enumerate(["aa", "zz"] * 60)]
    docs = spark.createDataFrame([*rows, (500, None, "aa"), (501, "", "aa"), (502, "12 !", "aa"), (503, "abc", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.predict_documents(docs, language_id.fit(docs.where("doc_id < 80"))).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (500, 501, 502))
    assert language_id.predict_documents(docs, language_id.fit(docs.where("false"))).where("lang_pred <> 'und'").count() == 0


def test_toxicity(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice(["an", "the", "ing", "or", "ea", "st"]) for _ in range(3)) for _ in range(300)]
    bad = ["worthless", "pathetic", "disgusting"]
    rows = [(i, " ".join(rng.choice(words) if rng.random() > (0.08 if i % 3 == 0 else 0) else rng.choice(bad) for _ in range(80))) for i in range(300)]
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] + [(250, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    assert np.mean([(got[i] >= 0.7) == (i % 3 == 0) for i in range(200, 300)]) > 0.9 and 0 <= got[900] == got[901] < 0.7
    assert toxicity.reject_toxic(docs, model).columns == docs.columns


def test_html():
    tree = html_extraction.train_tree()
    page = "<nav><a href=x>Home</a></nav><article><h1>A &amp; B</h1><p>Some <b>bo</b>ld text.<p class='ad'>Buy!</p><script>'</p>'</script><p>More.</p></article><footer>(c)</footer>"
    assert html_extraction.main_text(page, tree) == "A & B Some bold text. More."
    assert html_extraction.main_text(None, tree) == "" == html_extraction.main_text("", tree)
    html_extraction.main_text("<" * 500 + "<p" * 50 + "<!--", tree)


def test_html_states_are_no_places():
    tree, words = html_extraction.train_tree(), " ".join(f"word{i}" for i in range(60))
    assert html_extraction.main_text(f"<body><div class='content has-sidebar'><article><p>{words}</p></article></div>", tree) == words
    assert html_extraction.main_text(f"<article class='post share-enabled'><p>{words}</p></article><div class='sidebar'>Also</div>", tree) == words


@pytest.mark.parametrize("keep", ["<article class='post type-post category-legal tag-search'>{}</article>", "<main><article class='story advert-free'>{}</article></main>", "<div id='content' class='post comments-open'>{}</div>", "<main><section class='hidden-gems'>{}</section></main>", "<article id='post-1' class='status-publish has-sidebar'>{}</article>", "<div class='footer-visible'><article>{}</article></div>"])
def test_names_that_only_hold_a_place_word_are_no_places(keep):
    tree, words = html_extraction.train_tree(), " ".join(f"word{i}" for i in range(60))
    parts = ["<div class='site-footer'>", "<div class='comment_list'>", "<section id='related-posts'>", "<div class='left-sidebar'>", "<div class='newsletter-box'>", "<article class='comment'>", "<ul class='menu-items'>", "<div class='Cookie-Notice'>"]
    outside = "".join(f"{p}<p>{words}</p></{p[1:].split()[0]}>" for p in parts)
    assert html_extraction.main_text(f"<body>{keep.format(f'<p>{words}</p>')}{outside}</body>", tree) == words


@pytest.mark.parametrize("page", ["<a " * 300_000, '<a "' * 250_000, "<a '\"" * 200_000 + ">", "<div>" * 150_000, "</b>" * 200_000, "<script>" + "</script " * 100_000])
def test_html_of_unclosed_tags_takes_linear_time(page):
    began = time.process_time()
    html_extraction.main_text(page, html_extraction.train_tree())
    assert time.process_time() - began < 20


def test_empty_tables(spark, docs, tmp_path):
    none = docs.where("false")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for out in (
        suffix_dedup.remove_repeats(none, 40, 8), packing.pack_documents(none, packing.vocabulary_path()), line_dedup.dedup_lines(none), jaccard_join.jaccard_components(none, 5, 80),
        toxicity.score_documents(none, toxicity.fit(none, labels)), toxicity.reject_toxic(none, toxicity.fit(docs, labels)), language_id.predict_documents(none, language_id.fit(none)),
        html_extraction.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")),
        topk_search.top_k(*[spark.createDataFrame([], "vec_id long, embedding array<double>")] * 2, "vec_id", "embedding"),
    ):
        assert out.count() == 0


def test_repeated_rows(docs):
    """A row repeated in full fares as each of its copies would, and a copy of a text is a copy of it."""
    twice = docs.unionByName(docs)
    n = 2 * docs.count()
    assert jaccard_join.jaccard_components(twice, 3, 80).count() == n
    assert {tuple(r) for r in jaccard_join.jaccard_components(twice, 3, 80).collect()} == {tuple(r) for r in jaccard_join.jaccard_components(docs, 3, 80).collect()}
    assert all(r.n_removed == r.n_bytes for r in suffix_dedup.remove_repeats(twice, 40, 8).collect() if r.n_bytes >= 40)
    assert hilbert_sharding.shard_documents(twice, 7).count() == n and line_dedup.dedup_lines(twice).count() == n


def test_near_duplicates_stage_equals_brute_force(spark, docs):
    """The stage keeps one document of each group, and all its columns."""
    more = docs.withColumn("set", F.lit("x")).withColumn("component_id", F.lit(1))
    kept = corpus_pipeline.near_duplicates(spark, more, "")
    assert kept.columns == more.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in _components(docs, 5, 80).items() if i == c}


def test_shared_folder(spark):
    df = common.materialize(spark.range(5))
    assert df.count() == 5 and "unisono-" in df.inputFiles()[0]
    common.remove(df)


def test_edges_with_clashing_columns(spark, docs):
    more = docs.withColumn("n_lines", F.lit("x")).withColumn("score", F.lit(1)).withColumn("shard", F.lit(2))
    assert line_dedup.dedup_lines(more).count() == more.count()
    assert hilbert_sharding.shard_documents(more, 3).count() == more.count()

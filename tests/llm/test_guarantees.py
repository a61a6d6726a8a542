"""Brute force and stated guarantees of the training-data operators: names, sites, short items, trials, stretches."""

import math
import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsekit.llm import decontaminate as DC
from pulsekit.llm import neardup as ND
from pulsekit.llm import paragraph_dedup as PD
from pulsekit.llm import line_spread, ngram_join, paragraph_dedup, quality_rules as QR, toxicity_fm
from pulsekit.llm import textarrays as TA
from pulsekit.llm.sampling import log_binomial_tail

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# every name that a query of these operators gives a column of its own
INTERNAL = ["label", "rate", "draw", "lid", "row", "k1", "k2", "score", "hkey", "hits", "line", "l", "key", "ckey", "site",
            "first", "often", "n", "id", "wid", "wdoc", "doc", "rep", "cid", "grp", "size", "comp", "kid", "item", "tkey",
            "_line_key", "_line_hits", "_leak_key", "_wid", "_wdoc", "shift", "seed", "pos", "wkey", "rdoc", "gone", "stratum"]


@pytest.fixture(scope="module")
def crowded(spark):
    """A small table with a column of every internal name."""
    rng = random.Random(12)
    text = [" ".join(f"w{rng.randrange(300)}" for _ in range(60)) for _ in range(12)]
    text += [text[0], text[1] + " tail", "Shared line of all sites\n" + text[2], None, ""]
    text += ["Shared line of all sites\n" + " ".join(f"v{rng.randrange(300)}" for _ in range(30)) for _ in range(12)]
    names = [n for n in INTERNAL if n not in ("doc_id", "text")]
    rows = [(i, t, "en", f"s{i % 11}", len(t or ""), *[f"x{j}" for j in range(len(names))]) for i, t in enumerate(text)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame(rows, schema)


def test_no_column_name_clashes(spark, crowded):
    plain = crowded.select("doc_id", "text", "lang", "source", "n_chars")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "zz " * 12), (2, crowded.first().text)], "item_id long, text string")

    def same(run):
        wide, narrow = run(crowded), run(plain)
        extra = [c for c in wide.columns if c in INTERNAL and c not in narrow.columns]
        key = str
        assert sorted(map(tuple, wide.select(narrow.columns).collect()), key=key) == sorted(map(tuple, narrow.collect()), key=key)
        return wide, extra

    for run in (lambda d: toxicity_fm.drop_toxic(spark, d, d, labels), lambda d: line_spread.strip_lines(spark, d),
                lambda d: line_spread.strip_lines(spark, d, copies_once=True),
                lambda d: ngram_join.keep_one_per_class(spark, d), lambda d: DC.drop_leaks(spark, d, bench)):
        wide, extra = same(run)
        assert wide.columns == crowded.columns and len(extra) == len(INTERNAL)
        assert all(r[c] == f"x{INTERNAL.index(c)}" for r in wide.collect() for c in extra)
    same(lambda d: toxicity_fm.score_toxicity(spark, d, labels).drop("score"))
    same(lambda d: DC.find_leaks(spark, d, bench))
    same(lambda d: line_spread.line_report(spark, d))
    same(lambda d: paragraph_dedup.dedup_paragraphs(spark, d))
    same(lambda d: QR.apply_rules(spark, d, labels))


# ------------------------------------------------------------------ operator 7

def test_every_site_of_a_line_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sites, texts = defaultdict(set), {}
    for r in docs.select("doc_id", "text", "source").collect():
        texts[r.doc_id] = r.text
        for line in (r.text or "").split("\n"):
            if bare := line.strip(" \t\r\x0b\x0c"):
                sites[bare].add(r.source)
    spread = {line for line, s in sites.items() if len(s) >= 10}
    assert len(spread) == 15
    assert line_spread.boilerplate(spark, docs).count() == 15
    got = {r.doc_id: r for r in line_spread.line_report(spark, docs).collect()}
    for i, text in texts.items():
        lines = [b for x in (text or "").split("\n") if (b := x.strip(" \t\r\x0b\x0c"))]
        assert got[i].n_lines == len(lines) and got[i].n_removed == sum(x in spread for x in lines)


def test_copies_count_once_only_when_asked(spark):
    docs = spark.createDataFrame([(i, "one line here\nanother", f"s{i}", 0) for i in range(12)] + [(99, "another", "t", 0)],
                                 "doc_id long, text string, source string, n_chars long")
    assert {r.text for r in line_spread.strip_lines(spark, docs).collect()} == {""}
    assert {r.text for r in line_spread.strip_lines(spark, docs, copies_once=True).collect()} == {"one line here\nanother", "another"}


# ------------------------------------------------------------------ operator 4

def test_short_items_do_not_flag_common_speech(spark):
    rng = random.Random(3)
    words = ["the", "la", "of", "and", "que", "river", "stone", "seven", "green", "walks", "under", "bridge"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(50)]
    seven = "Only seven green rivers walk beneath stones"
    docs += [(100, "before it " + seven.upper() + ", and after"), (101, "before it only seven green rivers walk under stones"),
             (102, "日本語の文章はここにあり、十分に長い。"), (103, "日本語")]
    bench = [(1, "the"), (2, "la"), (3, "of the"), (4, "the river of stone"), (5, seven), (6, None), (7, ""),
             (8, "日本語の文章はここにあり"), (9, "日本語")]
    docs, bench = (spark.createDataFrame(x, s) for x, s in ((docs, "doc_id long, text string"), (bench, "item_id long, text string")))
    flagged = {r.doc_id: r.item_ids for r in DC.find_leaks(spark, docs, bench).where("contaminated").collect()}
    assert flagged == {100: [5]}  # its word is the whole run: another run of letters holds more
    alone = docs.unionByName(spark.createDataFrame([(104, "x 日本語の文章はここにあり y")], "doc_id long, text string"))
    assert {r.doc_id for r in DC.find_leaks(spark, alone, bench).where("contaminated").collect()} == {100, 104}
    assert {r.item_id for r in DC.unsearchable(bench).collect()} == {1, 2, 3, 4, 6, 7, 9}


def test_leaks_equal_brute_force_over_all_alignments(spark):
    rng = random.Random(21)
    vocabulary = [f"w{i}" for i in range(40)]

    def sentence(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = [sentence(n) for n in (5, 6, 8, 9, 10, 10, 11, 12, 13, 14, 15, 16, 20, 33, 59)]
    texts = []
    for _ in range(150):
        words = sentence(rng.randrange(0, 40))
        for _ in range(rng.randrange(0, 3)):
            part = list(rng.choice(items))
            a = rng.randrange(0, max(1, len(part) - 8))
            part = part[a:a + rng.randrange(8, 40)]
            for _ in range(rng.randrange(0, 5)):  # substituted words
                part[rng.randrange(len(part))] = rng.choice(vocabulary)
            words = words[:10] + part + words[10:]
        texts.append(words)

    def leaks(doc, item):
        n = min(len(item), DC.WINDOW)
        need = n if len(item) < DC.MIN_ITEM else math.ceil(DC.AGREE * n - 1e-9)
        return any(sum(doc[s + i] == item[a + i] for i in range(n)) >= need
                   for a in range(len(item) - n + 1) for s in range(len(doc) - n + 1))

    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in DC.find_leaks(spark, docs, bench).collect()}
    want = {i: [j for j, item in enumerate(items) if leaks(t, item)] for i, t in enumerate(texts)}
    assert got == want and sum(map(len, want.values())) > 40


# ------------------------------------------------------------------ operator 9

def test_binomial_tail_is_exact_and_never_too_small():
    for n, k, p in [(10, 3, 0.3), (50, 0, 0.02), (400, 9, 0.05), (400, 40, 0.05), (1000, 1, 0.01)]:
        q = Fraction(p)
        want = sum(math.comb(n, i) * q ** i * (1 - q) ** (n - i) for i in range(k + 1))
        assert log_binomial_tail(n, k, p) == pytest.approx(math.log(want), abs=1e-11)
    # far beyond any fixed number of terms: the normal limit
    n, p = 10 ** 10, 0.02
    sd = math.sqrt(n * p * (1 - p))
    for z in (0.5, 1.0, 2.0, 4.0):
        k = int(n * p - z * sd)
        assert log_binomial_tail(n, k, p) == pytest.approx(math.log(0.5 * math.erfc(z / math.sqrt(2))), abs=2e-3)


def measured(spark, rows):
    """Rows (doc_id, stratum, key, symbols per 100 words) as measured counts."""
    return spark.createDataFrame(
        [(d, s, key, 100, 500, n, 0, 0, 10, 0, 0) for d, s, key, n in rows],
        "doc_id long, stratum string, key long, " + ", ".join(f"{c} long" for c in QR.COUNTS))


def test_copies_and_repeated_rows_certify_nothing_more(spark):
    rng = random.Random(5)
    good = [(i, "en", i, rng.choice([0, 1, 2, 3])) for i in range(300)]
    bad = [(1000 + i, "en", 1000 + i, 95) for i in range(40)]
    labels = spark.createDataFrame([(d, 1) for d, *_ in good] + [(d, 0) for d, *_ in bad], "doc_id long, quality int")

    def cutoffs(rows, labels):
        return sorted(map(tuple, QR.certified_cutoffs(spark, measured(spark, rows), labels, 0.3, 0.05).collect()))

    once = cutoffs(good + bad, labels)
    assert once  # there is something to certify
    assert cutoffs((good + bad) * 32, labels) == once  # the table 32 times over
    few = good[:12] + bad
    copies = [(d + 10_000 * c, s, key, n) for c in range(32) for d, s, key, n in good[:12]]  # other ids, the same texts
    more = spark.createDataFrame([(d, 1) for d, *_ in copies], "doc_id long, quality int")
    assert cutoffs(few + copies, labels.unionByName(more)) == cutoffs(few, labels) == []


def test_false_rejections_stay_within_the_bound(spark):
    """150 independent strata: the chosen cutoff rejects more than its share of good documents in at most delta of them."""
    rng = random.Random(9)
    grid = QR.GRIDS["symbol_rate"]
    alpha, share = 0.6, 0.6 / len(QR.GRIDS)  # a rule may reject a tenth of the good documents
    rates = np.linspace(0.02, 0.2, len(grid))  # true share of good documents at or beyond each cutoff
    rows, labels = [], []
    for s in range(150):
        for i in range(520):
            doc = s * 1000 + i
            if i < 200:
                u = rng.random()
                first = next((j for j in range(len(grid)) if u < rates[j]), None)
                n = 0 if first is None else math.ceil(100 * grid[first] - 1e-9)
            else:
                n = 250
            rows.append((doc, f"s{s}", doc, n))
            labels.append((doc, int(i < 200)))
    delta = 0.05 * len(QR.GRIDS) * 150  # 0.05 for each test after the division over rules and strata
    chosen = QR.certified_cutoffs(spark, measured(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int"),
                                  alpha, delta).where("rule = 'symbol_rate'").collect()
    beyond = sum(rates[len(grid) - r["index"]] > share for r in chosen)
    assert len(chosen) > 75 and beyond <= 150 * 0.05 + 4 * math.sqrt(150 * 0.05 * 0.95)


# ------------------------------------------------------------------ operator 6

def test_shared_stretches_go_and_unshared_text_stays(spark):
    """Lines too short to be paragraphs: what is cut is exactly what stands in a stretch of 50 words of an earlier place."""
    rng = random.Random(14)

    def words(n):
        return [f"u{rng.randrange(10 ** 9)}" for _ in range(n)]

    shared = [words(n) for n in (50, 51, 63, 90, 140, 49, 30)]
    docs = []
    for i in range(60):
        out = words(rng.randrange(20, 80))
        for _ in range(rng.randrange(0, 3)):
            out += rng.choice(shared) + words(rng.randrange(1, 60))
        lines, at = [], 0
        while at < len(out):  # lines of under 20 words, cut differently in every document
            n = rng.randrange(3, 19)
            lines.append(" ".join(out[at:at + n]))
            at += n
        docs.append((i, "\n".join(lines)))
    first, gone = {}, defaultdict(set)
    split = {i: WORD.findall(t) for i, t in docs}
    for i in sorted(split):
        w = split[i]
        for s in range(len(w) - 49):
            g = tuple(w[s:s + 50])
            if first.setdefault(g, (i, s)) != (i, s):
                gone[i].update(range(s, s + 50))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for r in paragraph_dedup.dedup_paragraphs(spark, df).collect():
        want = [x for j, x in enumerate(split[r.doc_id]) if j not in gone[r.doc_id]]
        assert WORD.findall(r.kept_text) == want
    assert gone


def test_hub_links_of_sorted_buckets():
    from pulsekit.llm.neardup import _hub_links
    rng = random.Random(1)
    rows = sorted((rng.randrange(30), rng.randrange(40)) for _ in range(900))
    cuts = [0, 1, 2, 300, 301, 640, 900]
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows[a:b])], ["bucket", "id"])
               for a, b in zip(cuts, cuts[1:])]
    got = [(a, b) for r in _hub_links(iter(batches)) for a, b in zip(*(c.to_pylist() for c in r.columns))]
    members = defaultdict(set)
    for b, i in rows:
        members[b].add(i)
    want = [(i, min(m)) for m in members.values() for i in m if i != min(m)]
    assert sorted(got) == sorted(want)


def test_long_texts_are_handled_whole(spark):
    """A text of several chunks: the same result as its parts say."""
    rng = random.Random(2)
    filler = [" ".join(f"f{rng.randrange(10 ** 9)}" for _ in range(30)) for _ in range(8000)]
    line = "A paragraph of exactly more than twenty words stands at the far end of a very long text and again in a short one, so"
    long = "\n".join([*filler, line])
    assert len(long) > 2 * TA.CHUNK_BYTES
    df = spark.createDataFrame([(1, long), (2, line)], "doc_id long, text string")
    out = {r.doc_id: r for r in paragraph_dedup.dedup_paragraphs(spark, df).collect()}
    assert out[1].kept_text == long and out[2].kept_text == "" and out[1].n_shared == out[2].n_shared == 1


# ------------------------------------------------------------------ operator 2

def test_scores_equal_the_sum_over_all_pairs_of_terms(spark):
    """The fitted machine on whole texts, with every pairwise interaction written out."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id % 9 = 0")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    all_docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = toxicity_fm.fit(spark, all_docs, labels)
    assert "w" in model
    got = {r.doc_id: r.score for r in toxicity_fm.score_texts(spark, docs, model).collect()}
    for r in docs.select("doc_id", "text").collect():
        terms = sorted(set(re.findall(rb"[a-z0-9\x80-\xff]+", (r.text or "").lower().encode())))
        w, v = [], []
        for t in terms:
            data = np.frombuffer(t + b"\0" * 8, np.uint8)
            _, ids = TA.subword_ids(data, np.array([0]), np.array([len(t)]), toxicity_fm.BUCKETS, toxicity_fm.PREFIXES,
                                    toxicity_fm.SUFFIXES, toxicity_fm.GRAM)
            w.append(float(model["w"][ids].astype(float).sum()))
            v.append(model["v"][ids].astype(float).sum(axis=0))
        z = model["b"] + sum(w)
        if len(terms) > 1:
            g = np.array(v) @ np.array(v).T
            z += float(np.triu(g, 1).sum()) / len(terms)  # each pair once, each term with 1 / sqrt(n)
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), abs=2e-4)


# ------------------------------------------------------------------ empty tables and repeated rows

def test_empty_tables_of_the_learned_operators(spark):
    from pulsekit.llm import language_crf
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert language_crf.identify(spark, docs).collect() == []
    assert QR.apply_rules(spark, docs, labels).collect() == []
    assert toxicity_fm.score_toxicity(spark, docs, labels).collect() == []


def test_mixing_draws_equal_rows_alike_and_keeps_to_the_budget(spark):
    from pulsekit.llm import mixing
    rng = random.Random(31)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 30)), ["a", "a", "a", "a", "b", "c", None][i % 7]) for i in range(700)]
    rows += rows[:40] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = mixing.mix(spark, docs).collect()
    drawn = defaultdict(int)
    for r in out:
        drawn[r.doc_id, r.epoch] += 1
    for (doc, _), n in drawn.items():
        assert n == (4 if doc < 40 else 1)  # all copies of a row or none
    tokens, target = defaultdict(int), {}
    for r in out:
        tokens[r.source] += r.n_tokens
    per = docs.selectExpr("coalesce(source, '\\0null') AS source", "regexp_count(text, 'w') AS n_tokens").where("n_tokens > 0")
    for r in mixing.mixing_weights(per).collect():
        target[r.source] = r.target
    longest = 4 * 29  # the last document of a block and its copies may not fit
    assert all(target[s] - longest < tokens[s] <= target[s] for s in target)


def test_many_sources_meet_no_single_row(spark):
    """Weights of 200,000 sources: sums only, and the same exponent as the sums in plain arithmetic."""
    from pulsekit.llm import mixing
    per = spark.range(200_000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("source"),
                                      (F.col("id") % 97 * 13 + 5).alias("n_tokens"))
    got = mixing.mixing_weights(per, target_entropy=0.995, max_repeats=3.0)
    x = got.first().exponent
    t = np.array([i % 97 * 13 + 5 for i in range(200_000)], dtype=float)

    def figures(e):
        q = (t / t.sum()) ** e
        q /= q.sum()
        return -(q * np.log(q)).sum(), (q * t.sum() / t).max()
    goal = 0.995 * math.log(len(t))
    lo, hi = 0.0, 1.0
    for _ in range(50):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if figures(mid)[0] >= goal else (lo, mid)
    by_entropy = 1.0 if figures(1.0)[0] >= goal else lo
    lo, hi = 0.0, 1.0
    for _ in range(50):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if figures(mid)[1] > 3.0 else (lo, mid)
    assert x == pytest.approx(max(by_entropy, 0.0 if figures(0.0)[1] <= 3.0 else hi), abs=1e-8)
    assert got.agg(F.sum("weight")).first()[0] == pytest.approx(1.0, abs=1e-4)
    assert "collect_list" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_small_groups_verified_together_equal_one_by_one():
    rng = np.random.default_rng(7)
    units = []
    for g in range(200):
        base = rng.integers(0, 1 << 62, 40, dtype=np.uint64)
        sets = []
        for _ in range(int(rng.integers(2, ND.SMALL + 1))):
            s = base.copy()
            s[rng.integers(0, 40, int(rng.integers(0, 7)))] = rng.integers(0, 1 << 62, dtype=np.uint64)
            sets.append(np.unique(s))
        n = len(sets)
        units.append((rng.integers(-1 << 60, 1 << 60, n), rng.integers(1, 4, n), np.zeros(n, np.int64),
                      np.array([len(s) for s in sets]), np.concatenate(sets)))
    # a unit that holds the very grams of another stays apart from it
    units.append((units[0][0] + 1, *units[0][1:]))
    got = sorted(zip(*(x.tolist() for x in ND._verify_small(units, ND.THRESHOLD))))
    want = []
    for ids, weights, side, size, grams in units:
        one = ND._verify_unit(ids, weights.astype(float), side, np.split(grams, np.cumsum(size)[:-1]), True, ND.THRESHOLD)
        want += zip(one[0].tolist(), one[1].astype(int).tolist(), one[2].tolist())
    assert got == sorted(want) and got


def test_passes_without_grams_see_the_same_units():
    text = pa.array([" ".join(f"w{i}." for i in range(130)) + "\n" + " ".join(f"v{i}" for i in range(30)), "", None, "a b"])
    (c,) = TA.text_chunks(text)
    full, bare = PD._units(c, 5, 20, 60, True)[0], PD._units(c, 5, 20, 60, True, False)[0]
    assert len(full.ids) and (full.ids == bare.ids).all() and (full.first == bare.first).all()
    assert (full.kind == bare.kind).all() and (full.count == bare.count).all() and (full.line == bare.line).all()
    assert not len(PD._units(c, 5, 20, 60, True, False)[1])


def test_packed_keys_link_buckets_and_name_repeated_units():
    rng = np.random.default_rng(3)
    held = [(rng.integers(-40, 40, 60), rng.integers(0, 9, 60), rng.integers(-200, 200, 50)) for _ in range(4)]
    rows = [r for some in (held[:1], held[1:]) for r in ND.packed_keys(some, 7).to_pylist()]
    rows.sort(key=lambda r: r["part"])
    batches = [pa.RecordBatch.from_pylist(rows[a:a + 3], schema=pa.schema(
        [("part", pa.int64()), *[(x, pa.binary()) for x in ("buckets", "ids", "units")]])) for a in range(0, len(rows), 3)]
    got = [x for b in ND._part_links(iter(batches)) for x in zip(*(c.to_pylist() for c in b.columns))]
    buckets, ids, units = (np.concatenate(x).tolist() for x in zip(*held))
    own = [a for a, b in got if a == b]
    assert sorted(own) == sorted(u for u in set(units) if units.count(u) > 1)
    items = defaultdict(set)
    for b, i in zip(buckets, ids):
        items[b].add(i)
    links = [set(x) for x in got if x[0] != x[1]]
    for there in items.values():  # all items of a bucket hang together
        reached, found = {min(there)}, True
        while found:
            found = [x for x in links if x & reached and not x <= reached]
            reached |= set().union(*found)
        assert there <= reached


def test_texts_are_cut_as_span_by_span():
    rng = random.Random(5)
    texts, drops = [None, "", "a"], [None, [], None]
    for _ in range(200):
        words = [rng.choice(["é", "word", "x"]) + rng.choice([" ", "\n", "\n\n"]) for _ in range(rng.randrange(1, 40))]
        raw = "".join(words).encode()
        spans = [m.span() for m in re.finditer(rb"[^ \n]+(?:[ \n]+[^ \n]+){0,5}", raw)]
        spans += [m.span() for m in re.finditer(rb"[^ \n]+", raw)]
        texts.append(raw.decode())
        drops.append([{"pos": a, "end": b} for a, b in rng.sample(spans, rng.randrange(len(spans) + 1) // 2)])
    want = []
    for text, drop in zip(texts, drops):
        raw, cut = (text or "").encode(), []
        for s, e in sorted((x["pos"], x["end"]) for x in drop or ()):
            if cut and s < cut[-1][1]:
                cut[-1][1] = max(cut[-1][1], e)
            else:
                cut.append([s, e])
        kept, at = b"", 0
        for s, e in cut:
            kept += raw[at:s]
            at = e + 1 if raw[e:e + 1] == b"\n" and raw[max(s - 1, 0):s] in (b"", b"\n") else e
        want.append((len(cut), [{"start": s, "end": e} for s, e in cut], (kept + raw[at:]).decode()))
    batch = pa.RecordBatch.from_pylist(
        [{"doc_id": i, "text": t, "drop": d, "n_shared": 0} for i, (t, d) in enumerate(zip(texts, drops))], schema=pa.schema(
            [("doc_id", pa.int64()), ("text", pa.string()), ("n_shared", pa.int64()),
             ("drop", pa.list_(pa.struct([("pos", pa.int64()), ("end", pa.int64())])))]))
    got = [r for part in (batch.slice(0, 50), batch.slice(50)) for b in PD._cut_texts(20)(iter([part])) for r in b.to_pylist()]
    assert [(r["n_removed"], r["spans"], r["kept_text"]) for r in got] == want
    assert PD._strings(np.frombuffer(b"ab\xc3\xa9\xff", np.uint8), np.array([0, 2, 3, 5])).to_pylist() == ["ab", "\ufffd", "\ufffd\ufffd"]

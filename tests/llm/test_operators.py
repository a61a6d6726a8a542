"""The training-data operators against brute force on small tables with every kind of odd row."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pulsekit.llm import (
    decontaminate, language_crf, license_scan, line_spread, mixing, neardup, ngram_join, paragraph_dedup,
    quality_rules, substring_dedup, toxicity_fm,
)
from pulsekit.llm.components import connected_components
from pulsekit.llm.sampling import log_binomial_tail
from pulsekit.llm.suffix_array import suffix_array

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, grp long, row string, key long"
LABELS = "doc_id long, quality int, toxic int, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ".", "é"]) for _ in range(n)]


def prose(rng, n):
    return " ".join(words(rng, n))


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, shared passages and lines, a long text, odd and missing texts."""
    rng = random.Random(3)
    passage, line = prose(rng, 90), "Share this page with your friends."
    base = [prose(rng, 40 + 10 * i) for i in range(8)]
    out = [*base, base[0], base[0], base[1]]
    near = base[2].split()
    near[5] = "changed"
    out += [" ".join(near), " ".join(near[:-1])]
    out += [prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 30) for _ in range(4)]
    out += [prose(rng, 25) + "\n" + line + "\n" + prose(rng, 25) for _ in range(14)]
    out += [passage + "\n" + passage, "ab " * 400, "x" * 1500, prose(rng, 9000), "one two", "one two", "", " \n\t ", None, None]
    return out


def rows_of(texts, extra=()):
    return [(i, t, ["en", "de", None][i % 3], f"site{i % 13}" if i % 17 else None, len(t or ""), "x", 1, "r", 5)
            for i, t in enumerate(texts)] + list(extra)


@pytest.fixture(scope="module")
def docs(spark, texts):
    again = [(0, texts[0], "en", "site1", 3, "x", 1, "r", 5), (None, texts[3], "en", "site2", 3, None, None, None, None)]
    return spark.createDataFrame(rows_of(texts, again), SCHEMA).repartition(5)


def sets_of(text):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


# ------------------------------------------------------------------ shared parts
def test_suffix_array_equals_sorting():
    rng = random.Random(1)
    for _ in range(2000):
        s = [rng.randrange(rng.choice([1, 2, 4])) for _ in range(rng.randrange(30))]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_bands_reach_the_recall():
    for recall in (0.9, 0.99, 0.9999):
        b, r = neardup.choose_bands(0.8, recall)
        assert 1 - (1 - 0.8 ** r) ** b >= recall and b * r <= 96
    with pytest.raises(ValueError):
        neardup.choose_bands(0.1, 0.999999, 4)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(500 + i, 501 + i) for i in range(40)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = connected_components(spark, spark.createDataFrame(edges, "a long, b long"))
    assert {r.id: r.comp for r in got.collect()} == {x: find(x) for x in list(parent)}
    assert connected_components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_binomial_tail():
    from math import comb, exp
    for n, k, p in ((20, 3, 0.1), (50, 0, 0.02), (7, 7, 0.3)):
        want = sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(exp(log_binomial_tail(n, k, p)) - want) < 1e-12


# ------------------------------------------------------------------ operator 1
@pytest.mark.parametrize("most", [4096, 1])
def test_op1_equals_brute_force(spark, docs, most):
    length = 400
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]
    count = Counter(b[s:s + length] for _, b in rows for s in range(len(b) - length + 1))
    want = []
    for i, b in rows:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if count[b[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(x for x, y in zip(b, gone) if not y)
        want.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in substring_dedup.remove_repeats(spark, docs, max_contexts=most).collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=lambda r: (r[0] or -1, r[1:])) == sorted(want, key=lambda r: (r[0] or -1, r[1:]))
    assert sum(w[2] for w in want) > 1000 and key


# ------------------------------------------------------------------ operator 2
def test_op2_learns_pairs_and_handles_odd_rows(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(900):
        toxic = int(rng.random() < 0.4)
        w = words(rng, 30)
        if toxic:
            w[3], w[9] = "badword", "themgroup"
        rows.append((i, " ".join(w), "en", "s", 0, "x", 1, "r", 5))
        labels.append((i, 1, toxic, "t"))
    rows += [(9000, None, None, None, None, None, None, None, None), (9001, "", "en", "s", 0, "", 1, "", 1), (None, "themgroup badword", "en", "s", 0, "", 1, "", 1)]
    d, lab = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([*labels, (5, 1, None, ""), (None, 0, 1, "")], LABELS)
    out = toxicity_fm.score_toxicity(spark, d, lab).collect()
    truth = {i: t for i, _, t, _ in labels}
    held = [r for r in out if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert {r.held_out for r in held} == {True}
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    none = toxicity_fm.score_toxicity(spark, d, lab.limit(0)).collect()
    assert {r.predicted for r in none} == {0} and toxicity_fm.score_toxicity(spark, d.limit(0), lab).count() == 0
    again = toxicity_fm.score_toxicity(spark, d.unionByName(d), lab).distinct().collect()
    assert {(r.doc_id, r.score) for r in again} == {(r.doc_id, r.score) for r in out}
    kept = toxicity_fm.drop_toxic(spark, d, d, lab)
    assert kept.columns == d.columns and kept.count() < len(rows)


# ------------------------------------------------------------------ operator 3
def test_op3_equals_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets = [sets_of(t) for _, t in rows]
    n = len(rows)
    near = [[j for j in range(n) if j != i and sets[i] and sets[j]
             and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i], *(label[j] for j in near[i])]) for i in range(n)]
    ids = {x: min((rows[j][0] for j in range(n) if label[j] == x and rows[j][0] is not None), default=None) for x in label}
    want = Counter((rows[i][0], ids[label[i]], len(near[i])) for i in range(n))
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in ngram_join.similarity_classes(spark, docs).collect())
    assert got == want
    kept = ngram_join.keep_one_per_class(spark, docs)
    wordless = sum(1 for s in sets if not s)
    assert kept.columns == docs.columns
    assert kept.count() == len({label[i] for i in range(n) if sets[i]}) + wordless
    assert ngram_join.similarity_classes(spark, docs.limit(0)).count() == 0


def test_op3_counts_links_across_blocks(spark, monkeypatch):
    rng = random.Random(2)
    base = words(rng, 120)
    texts = []
    for i in range(40):
        w = list(base)
        w[i] = f"edit{i}"
        texts.append(" ".join(w))
    monkeypatch.setattr(neardup, "BLOCK", 7)
    out = ngram_join.similarity_classes(spark, spark.createDataFrame(rows_of(texts), SCHEMA)).collect()
    assert {r.class_id for r in out} == {0}
    sets = [sets_of(t) for t in texts]
    for r in out:
        a = sets[r.doc_id]
        assert r.n_links == sum(10 * len(a & b) >= 8 * len(a | b) for j, b in enumerate(sets) if j != r.doc_id)


# ------------------------------------------------------------------ operator 4
def test_op4_finds_substituted_passages(spark, docs):
    rng = random.Random(4)
    items = [(i, prose(rng, 30)) for i in range(6)] + [(50, None), (51, "too short"), (52, "")]
    leaks = []
    for i, text in items[:6]:
        w = text.split()
        for at in (4, 11, 19, 27):
            w[at] = "swapped"
        leaks.append((1000 + i, prose(rng, 50) + "\n" + " ".join(w).upper() + ", " + prose(rng, 40)))
    far = items[0][1].split()
    for at in range(0, 30, 2):
        far[at] = f"other{at}"
    d = docs.unionByName(spark.createDataFrame(
        [(i, t, "en", "s", 0, "", 1, "", 1) for i, t in [*leaks, (2000, " ".join(far))]], SCHEMA))
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, key string")
    out = {r.doc_id: r for r in decontaminate.find_leaks(spark, d, b).collect()}
    assert {i for i, r in out.items() if r.contaminated} == {1000 + i for i in range(6)}
    assert all(out[1000 + i].item_ids == [i] for i in range(6))
    assert decontaminate.drop_leaks(spark, d, b).count() == d.count() - 6
    assert decontaminate.find_leaks(spark, d, b.limit(0)).where("contaminated").count() == 0
    assert decontaminate.find_leaks(spark, d.limit(0), b).count() == 0



def test_op4_masks_reach_every_placement():
    from itertools import combinations
    for n, changed in ((10, 2), (11, 2), (12, 2), (13, 2), (14, 2), (15, 3)):
        for gone in combinations(range(n), changed):
            assert any(all(mask[j] == "0" or s + j not in gone for j in range(len(mask)))
                       for mask in decontaminate.MASKS for s in range(n - len(mask) + 1)), (n, gone)


def test_op4_finds_short_items(spark):
    items = [(0, "seven little words stand here in row"), (1, "\u4eca\u65e5\u306f\u3044\u3044\u5929\u6c17"), (2, "a b c d e f g h i j")]
    rows = [(0, "so SEVEN little words, stand here in row too"), (1, "x \u4eca\u65e5\u306f\u3044\u3044\u5929\u6c17 y"),
            (2, "q z b z d e f g h i j q"), (3, "seven little words stood here in row")]
    d = spark.createDataFrame([(i, t, "en", "s", 0, "", 1, "", 1) for i, t in rows], SCHEMA)
    out = decontaminate.find_leaks(spark, d, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: r.item_ids for r in out} == {0: [0], 1: [1], 2: [2], 3: []}


# ------------------------------------------------------------------ operator 5
def test_op5_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    lens = np.array([4, 1, 3])
    e, a = rng.normal(size=(8, 3)), rng.normal(size=(3, 3))
    got = language_crf.forward_backward(e, a, np.array([0, 4, 5]), lens)
    first = 0
    for n in lens:
        import itertools
        total = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            s = sum(e[first + t, y] for t, y in enumerate(path)) + sum(a[x, y] for x, y in zip(path, path[1:]))
            for t, y in enumerate(path):
                total[t, y] += np.exp(s)
        assert np.allclose(got[first:first + n], total / total.sum(1, keepdims=True))
        first += n


def test_op5_labels_languages_and_switches(spark):
    rng = random.Random(8)
    parts = {"en": ["the", "ing", "th", "wh", "ed"], "fr": ["eau", "oi", "é", "que", "le"]}

    def text(lang, n):
        return " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))

    rows = [(i, text(l, 25), l, "s", 0, "", 1, "", 1) for i in range(300) for l in [rng.choice(["en", "fr"])]]
    odd = [(900, None, "en", "s", 0, "", 1, "", 1), (901, "", "fr", "s", 0, "", 1, "", 1), (902, "12 ... 7!", "en", "s", 0, "", 1, "", 1),
           (None, text("fr", 9), None, None, 0, "", 1, "", 1)]
    d = spark.createDataFrame(rows + odd, SCHEMA)
    out = {r.doc_id: r for r in language_crf.identify(spark, d).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(out[r[0]].lang_pred == r[2] for r in held) / len(held) > 0.97
    assert [(out[i].lang_pred, out[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert out[None].lang_pred == "fr"
    model = language_crf.fit(spark, d)
    post, _ = language_crf.word_posteriors(pa.array([text("en", 12) + " " + text("fr", 12)]), model)
    assert post[:8].argmax(1).tolist() == [0] * 8 and post[-8:].argmax(1).tolist() == [1] * 8
    nothing = language_crf.identify(spark, d.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}



def test_op5_learns_from_few_pieces():
    texts = ["the thing that", "le que eau"] * 20
    model = language_crf._fit(pa.array(texts), ["en", "fr"] * 20)
    post, _ = language_crf.word_posteriors(pa.array(["the thing", "que eau"]), model)
    assert post.argmax(1).tolist() == [0, 0, 1, 1] and post.max(1).min() > 0.6


# ------------------------------------------------------------------ operator 6
def test_op6_removes_near_copies_of_paragraphs(spark, docs):
    rng = random.Random(6)
    para = words(rng, 45)
    near = list(para)
    near[43] = "edited"
    own = [prose(rng, 30) for _ in range(4)]
    rows = [(1, own[0] + "\n" + " ".join(para) + "\n" + own[1]), (2, " ".join(near) + "\n" + own[2]),
            (3, own[3] + "\n" + " ".join(para)), (4, " ".join(para[:10])), (5, None), (6, ""), (6, "")]
    d = spark.createDataFrame([(i, t, None, None, 0, "", 1, "", 1) for i, t in rows], SCHEMA)
    out = {r.doc_id: r for r in paragraph_dedup.dedup_paragraphs(spark, d).collect()}
    assert {i: r.n_removed for i, r in out.items()} == {1: 0, 2: 1, 3: 1, 4: 0, 5: 0, 6: 0}
    assert out[2].kept_text == own[2] and out[3].kept_text.strip() == own[3]
    assert out[1].kept_text == rows[0][1] and out[5].kept_text is None and out[6].kept_text == ""
    full = paragraph_dedup.dedup_paragraphs(spark, docs).collect()
    assert len(full) == docs.count() and all(r.n_removed <= r.n_paragraphs for r in full)
    assert paragraph_dedup.dedup_paragraphs(spark, docs.limit(0)).count() == 0



def test_op6_compares_whole_lines_of_any_length(spark):
    rng = random.Random(16)
    rows, n = [], 0
    for size in (60, 61, 90, 150):
        line = [x + "." if i % 9 == 8 else x for i, x in enumerate(f"s{size}x{rng.randrange(10 ** 6)}" for _ in range(size))]
        for at in (1, size // 3, size // 2):
            near = list(line)
            near[at] = "edited"
            rows.append((1000 + n, " ".join(near)))
            n += 1
        rows += [(size, " ".join(line)), (2000 + size, " ".join(line[:-1]))]
    d = spark.createDataFrame([(i, t, None, None, 0, "", 1, "", 1) for i, t in rows], SCHEMA)
    out = {r.doc_id: r for r in paragraph_dedup.dedup_paragraphs(spark, d).collect()}
    for i, t in rows:
        assert out[i].kept_text == (t if i < 1000 else ""), i



def test_op6_sees_passages_of_fifty_words_inside_lines(spark):
    rng = random.Random(26)
    fresh = lambda n: [f"u{rng.randrange(10 ** 9)}" for _ in range(n)]
    rows, cases = [], []
    for n, size in enumerate((50, 50, 55, 80, 120, 200) * 4):
        passage = fresh(size)
        rows += [(n, " ".join(fresh(120) + passage + fresh(130))), (1000 + n, " ".join(fresh(140) + passage + fresh(90)))]
        cases.append((n, passage))
    d = spark.createDataFrame([(i, t, None, None, 0, "", 1, "", 1) for i, t in rows], SCHEMA)
    out = {r.doc_id: r.kept_text for r in paragraph_dedup.dedup_paragraphs(spark, d).collect()}
    text = dict(rows)
    for n, passage in cases:
        assert out[n] == text[n]
        left = out[1000 + n].split()
        assert len(passage) - 48 <= 230 + len(passage) - len(left) <= len(passage) and len(left) < 230 + len(passage) - 25
        assert set(text[1000 + n].split()) - set(left) <= set(passage)


# ------------------------------------------------------------------ operator 7
def test_op7_equals_exact_counts(spark, docs):
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    first = {}
    for _, t, s in rows:
        if t is not None:
            first[t] = min(first.get(t, "~"), s if s is not None else "\x00null")
    sites = {}
    for t, s in first.items():
        for l in t.split("\n"):
            sites.setdefault(l.strip(" \t\r\x0b\x0c"), set()).add(s)
    gone = {l for l, s in sites.items() if l and len(s) >= 10}
    assert gone == {"Share this page with your friends."}

    def cut(t):
        return None if t is None else "\n".join(l for l in t.split("\n") if l.strip(" \t\r\x0b\x0c") not in gone)

    out = line_spread.strip_lines(spark, docs)
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((i, cut(t)) for i, t, _ in rows)
    report = line_spread.line_report(spark, docs).collect()
    assert len(report) == len(rows) and sum(r.n_removed for r in report) == 14
    assert line_spread.strip_lines(spark, docs.limit(0)).count() == 0


# ------------------------------------------------------------------ operator 8
def test_op8_matches_by_dice(spark, docs):
    body = license_scan.TEMPLATES["MIT-grant"]
    rows = [(1, "text before\nLicensed under CC BY-NC 4.0\nafter"), (2, body.upper()), (3, None), (4, ""), (5, "licensed"),
            (6, "This work is licensed under the GNU General Public License version 3"), (6, "nothing here at all")]
    d = spark.createDataFrame([(i, t, None, None, 0, "", 1, "", 1) for i, t in rows], SCHEMA)
    out = {}
    for r in license_scan.scan_licences(d).collect():
        out.setdefault(r.doc_id, []).append(r.best_licence)
    assert out[1] == ["CC-BY-NC-4.0"] and out[2] == ["MIT-grant"] and out[3] == out[4] == out[5] == [None]
    assert sorted(out[6], key=str) == ["GPL-3.0", None]

    def dice(a, b):
        a, b = set(license_scan.bigrams(a)), set(license_scan.bigrams(b))
        return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0

    for r in license_scan.scan_licences(d).collect():
        text = [t for i, t in rows if i == r.doc_id]
        best = max(max((dice(u, t) for u in [x or "", *(x or "").split("\n")] for t in license_scan.TEMPLATES.values()),
                       default=0) for x in text)
        assert r.best_dice <= round(best, 6) and (r.best_dice > 0) <= (best >= license_scan.THRESHOLD)
    assert license_scan.scan_licences(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ operator 9
def test_op9_counts_equal_brute_force(spark, docs):
    got = Counter(tuple(r)[:7] for r in quality_rules.apply_rules(
        spark, docs, spark.createDataFrame([], LABELS)).collect())
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        t = r.text or ""
        w = WORD.findall(t)
        n = len(w)
        c = Counter(tuple(w[i:i + 8]) for i in range(n - 7))
        inside = {j for i in range(n - 7) if c[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [l for l in t.split("\n") if WORD.search(l)]
        want[(r.doc_id, n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside),
              n < 20 or 100 * len(inside) > 30 * n)] += 1
    assert got == want


def test_op9_certifies_only_safe_cutoffs(spark):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(4000):
        good = rng.random() < 0.7
        w = words(rng, 30) if good else [x + "###" for x in words(rng, 30)]
        rows.append((i, " ".join(w), "en" if i % 2 else "de", "s", 0, "", 1, "", 1))
        labels.append((i, int(good), 0, ""))
    d, lab = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    out = {r.doc_id: r for r in quality_rules.apply_rules(spark, d, lab, alpha=0.06).collect()}
    good = [out[i] for i, q, _, _ in labels if q]
    bad = [out[i] for i, q, _, _ in labels if not q]
    assert sum(not r.kept for r in good) / len(good) <= 0.06
    assert sum(not r.kept for r in bad) / len(bad) > 0.99 and "symbol_rate" in bad[0].failed_rules
    few = quality_rules.apply_rules(spark, d, lab.limit(40), alpha=0.06).collect()
    assert all(r.kept for r in few)  # too few labels certify nothing


# ------------------------------------------------------------------ operator 10
def test_op10_weights_and_budget(spark):
    rng = random.Random(10)
    rows = []
    for i in range(600):
        source = "big" if i < 400 else ["a", "b", None][i % 3]
        rows.append((i, prose(rng, rng.randint(1, 60)), "en", source, 0, "", 1, "", 1))
    rows += [(700, None, "en", "a", 0, "", 1, "", 1), (701, "  ", "en", "a", 0, "", 1, "", 1)]
    d = spark.createDataFrame(rows, SCHEMA)
    tokens = {r[0]: len((r[1] or "").split()) for r in rows}
    total = sum(tokens.values())
    out = mixing.mix(spark, d, n_blocks=16).collect()
    assert all(tokens[r.doc_id] == r.n_tokens > 0 for r in out)
    per = spark.createDataFrame([((r[3] or mixing.NULL_SOURCE), tokens[r[0]]) for r in rows if tokens[r[0]]],
                                "source string, n_tokens long")
    w = {r.source: r for r in mixing.mixing_weights(per).collect()}
    q = np.array([r.weight for r in w.values()])
    assert abs(-(q * np.log(q)).sum() - 0.97 * np.log(4)) < 1e-6 and abs(q.sum() - 1) < 1e-6
    longest = max(tokens.values())
    for source, r in w.items():
        used = sum(x.n_tokens for x in out if x.source == source)
        assert r.target - longest < used <= r.target
        copies = Counter(x.doc_id for x in out if x.source == source)
        assert max(copies.values()) <= -(-r.target // r.tokens)
    assert sum(x.n_tokens for x in out) <= total
    tight = {r.source: r for r in mixing.mixing_weights(per, target_entropy=1.0, max_repeats=1.5).collect()}
    assert max(r.target / r.tokens for r in tight.values()) <= 1.5 + 1e-6
    assert mixing.mix(spark, d.limit(0)).count() == 0


# ------------------------------------------------------------------ pipeline
def test_pipeline_on_odd_rows(spark, tmp_path, texts):
    rng = random.Random(12)
    item = prose(rng, 40)
    extra = [(100 + i, prose(rng, 60) + " badword themgroup", "en", f"site{i % 13}", 0, "", 1, "", 1) for i in range(120)]
    clean = [(300 + i, prose(rng, 60), "en", f"site{i % 13}", 0, "", 1, "", 1) for i in range(120)]
    leak = [(500, prose(rng, 30) + " " + item + " " + prose(rng, 30), "en", "site1", 0, "", 1, "", 1)]
    d = spark.createDataFrame(rows_of(texts, extra + clean + leak), SCHEMA)
    d.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(r[0], 1, 1, "") for r in extra] + [(r[0], 1, 0, "") for r in clean], LABELS) \
        .write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, counts = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == d.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    cleaned = {r[0] for r in clean}
    assert not counts["toxicity"] & {r[0] for r in extra} and cleaned <= counts["decontamination"]
    assert counts["line_dedup"] == counts["toxicity"]
    assert len(counts["near_duplicates"] & {0, 8, 9}) <= 1 and 500 not in counts["decontamination"]
    empty = tmp_path / "none"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(str(tmp_path / f"{name}.parquet")).limit(0).write.parquet(str(empty / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0

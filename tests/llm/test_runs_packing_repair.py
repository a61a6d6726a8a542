"""Periodic runs, packing and conversation repair against plain versions."""

import hashlib
import json
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pulsekit.llm import conversation_repair as CR
from pulsekit.llm import packing, periodic_runs, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = "doc_id long, text string, lang string, source string, runs string, ids string, row string, n_words long"


def odd_docs(spark, texts):
    rows = [(i, t, None, "s", "x", "y", "z", 4) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "a b " * 30, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, ODD).repartition(3), rows


def odd_texts():
    rng = random.Random(7)
    words = ["alpha", "beta", "γάμμα", "d", "\x1c", "e.", "日本"]
    texts = ["", None, " \n\t ", "one", "a b " * 40, "z" * 3000, "\n".join(["the same line again"] * 30)]
    for _ in range(30):
        out = []
        for _ in range(rng.randrange(1, 6)):
            loop = [rng.choice(words[:rng.choice([1, 2, 7])]) for _ in range(rng.randrange(1, 12))]
            out += (loop * 40)[:rng.randrange(1, 60)]
        texts.append(rng.choice([" ", "\n", "  "]).join(out))
    texts.append(" ".join(f"w{rng.randrange(5000)}" for _ in range(20_000)) + " ring" * 500)
    return texts


# ------------------------------------------------------------------ operator 11

def plain_runs(w):
    """The full diagonal DP: every lag, every cell; the smallest period checked by definition."""
    out = set()
    for q in range(1, len(w) // 3 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            s, length = i - q, j - i + q
            if j > i and length >= max(24, 3 * q) and not any(
                    all(w[k] == w[k - d] for k in range(s + d, s + length)) for d in range(1, q)):
                out.add((s, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_report(doc_id, text, plant=True):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_runs_equal_the_full_diagonal_dp():
    rng = random.Random(5)
    for _ in range(300):
        ids = []
        for _ in range(rng.randrange(1, 5)):
            loop = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randrange(1, 24))]
            ids += (loop * 80)[:rng.randrange(1, 90)]
        assert periodic_runs.periodic_runs(np.array(ids)) == plain_runs(ids)
    assert periodic_runs.periodic_runs(np.zeros(100_000, dtype=int)) == [(0, 100_000, 1)]


def test_runs_query_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op11_periodic_runs(spark, SF).collect()
    want = [plain_report(r.doc_id, r.text) for r in docs]
    assert sorted(tuple(r)[:8] for r in got) == sorted(want, key=lambda r: r[0])
    assert any(r.n_runs for r in got)


def test_runs_odd_rows(spark):
    docs, rows = odd_docs(spark, odd_texts())
    got = periodic_runs.run_digests(periodic_runs.find_runs(docs)).collect()
    want = [plain_report(r[0], r[1], plant=False) for r in rows if len(r[1] or "") < 9000]
    key = str
    assert sorted((tuple(r)[:8] for r in got if r.n_words < 2000), key=key) == sorted(want, key=key)
    long = next(r for r in got if r.n_words == 20_500)
    assert (long.start, long.length, long.period) == (20_000, 500, 1)
    assert periodic_runs.find_runs(docs.limit(0)).collect() == []


def test_runs_tie_takes_the_earliest(spark):
    text = " ".join(["a b"] * 12 + ["x"] + ["c d"] * 12)
    row = periodic_runs.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(0, 24, 2), (25, 24, 2)] and tuple(row.strongest) == (0, 24, 2)
    assert row.collapsed == "a b x c d"


# ------------------------------------------------------------------ operator 12

@pytest.fixture(scope="module")
def tokenizer_path():
    return public_tokenizers.path("byte_bpe_50k.json")


def check_pieces(pieces, docs, tokenizer_path):
    """Every id in exactly one piece, sequences gapless and full but for powers of two. ``docs``: [(doc_id, text)]."""
    t = Tokenizer.from_file(tokenizer_path)
    ids = [(d, t.encode(x or "", add_special_tokens=False).ids + [0]) for d, x in docs]
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id, p.doc_tokens].append(p)
    taken = 0
    for d, x in ids:
        raw = np.array(x, dtype="<u4")
        mine = {(p.start, p.length) for p in by_doc[d, len(x)]
                if zlib.crc32(raw[p.start:p.start + p.length].tobytes()) == p.ids_crc32}
        assert sum(p.length for p in by_doc[d, len(x)]) % len(x) == 0 and mine
        taken += len(x)
    assert taken == sum(p.length for p in pieces)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == 1024 or at & (at - 1) == 0 and at < 1024
    return sequences


def exact_cover(pieces, docs, tokenizer_path):
    """The same for tables of distinct doc_ids: pieces are gapless in their document and hold its ids."""
    t = Tokenizer.from_file(tokenizer_path)
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for d, x in docs:
        raw = np.array(t.encode(x or "", add_special_tokens=False).ids + [0], dtype="<u4")
        at = 0
        for p in sorted(by_doc.pop(d), key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(raw)
            at += p.length
            assert zlib.crc32(raw[p.start:at].tobytes()) == p.ids_crc32
        assert at == len(raw)
    assert not by_doc


def test_packing_query_whole_table(spark, tokenizer_path):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    pieces = queries.op12_cost_packing(spark, SF).collect()
    exact_cover(pieces, docs, tokenizer_path)
    sequences = check_pieces(pieces, docs, tokenizer_path)
    assert sum(1 for p in sequences.values() if sum(n for _, n in p) < 1024) <= 10  # one block: one binary rest


def test_packing_odd_rows(spark, tokenizer_path):
    docs, rows = odd_docs(spark, [*odd_texts(), "<|endoftext|> ends here", "'s 's it's  \n x\x85"])
    pieces = packing.piece_digests(packing.pack_documents(docs, tokenizer_path, block_tokens=3000)).collect()
    check_pieces(pieces, [(r[0], r[1]) for r in rows], tokenizer_path)
    assert packing.pack_documents(docs.limit(0), tokenizer_path).collect() == []


def test_rests_follow_the_greedy_rule_and_balance_costs():
    rng = random.Random(2)
    lengths = np.array([min(1023, int(rng.paretovariate(0.8) * 20)) for _ in range(3000)])
    placed = packing.pack_rests(lengths)
    total = int(lengths.sum())
    room = [1024] * (total // 1024) + [1 << b for b in range(10, -1, -1) if total % 1024 >> b & 1]
    used, price, at, order = [0] * len(room), [0] * len(room), 0, sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:  # a plain version of the rule
        left = int(lengths[i])
        while left:
            fit = [k for k in range(len(room)) if room[k] - used[k] >= left] \
                or [k for k in range(len(room)) if room[k] > used[k]]
            k = min(fit, key=lambda k: price[k])
            n = min(left, room[k] - used[k])
            assert placed[at] == (i, int(lengths[i]) - left, n, k, used[k])
            used[k] += n
            price[k] += packing.cost(n)
            left, at = left - n, at + 1
    assert at == len(placed) and used == room

    # against the first sequence with room, the usual way to pack tightly, on the same order
    first_used, first_price = [0] * len(room), [0] * len(room)
    for i in order:
        left = int(lengths[i])
        while left:
            k = next((k for k in range(len(room)) if room[k] - first_used[k] >= left), None)
            k = k if k is not None else next(k for k in range(len(room)) if room[k] > first_used[k])
            n = min(left, room[k] - first_used[k])
            first_used[k] += n
            first_price[k] += packing.cost(n)
            left -= n
    full = total // 1024
    assert np.std(price[:full]) < np.std(first_price[:full])
    assert len(placed) < len(lengths) * 1.2  # few documents are cut


def test_segments_do_not_change_ids(tokenizer_path):
    t = Tokenizer.from_file(tokenizer_path)
    fast = packing.encoder(open(tokenizer_path, encoding="utf-8").read())
    rng = random.Random(3)
    pool = "aAbé日本🙂   \t\n\r\x1c\x85'sStTreRE01²٣.,!?_​﻿\x00"
    for _ in range(2000):
        s = "".join(rng.choice(pool) for _ in range(rng.randrange(1, 60)))
        want = t.encode(s, add_special_tokens=False).ids
        parts = packing.segments(s, longest=rng.randrange(1, 20))
        assert "".join(parts) == s and [x for ids in fast(parts) for x in ids] == want
    assert fast(["a <|endoftext|>b"]) == [t.encode("a <|endoftext|>b", add_special_tokens=False).ids]


def test_other_tokenizer_files_run_as_they_are():
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    assert packing._byte_ranks(json.load(open(path, encoding="utf-8"))) is None
    assert packing.encoder(open(path, encoding="utf-8").read())(["Some words, here."]) == [
        t.encode("Some words, here.", add_special_tokens=False).ids]


# ------------------------------------------------------------------ operator 13

def plain_repair(rows):
    """(cost, audit, written rows) by a forward DP over states with whole audits; rows: [(role, text, fault)]."""
    nxt = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    want = {"": "u", "s": "u", "u": "a", "a": "u"}

    def put(best, s, value):
        if s not in best or value < best[s]:
            best[s] = value

    def inserted(best):
        for _ in range(3):
            for s, (c, a, w) in list(best.items()):
                put(best, want[s], (c + 2, a + "I", [*w, ({"u": "user", "a": "assistant"}[want[s]], "")]))
        return best

    best = {"": (0, "", [])}
    for role, text, fault in rows:
        after = {}
        for s, (c, a, w) in inserted(best).items():
            put(after, s, (c + 3, a + "D", w))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if (s, role[:1]) in nxt:
                    put(after, nxt[s, role[:1]], (c + more, a + "K", [*w, (role, text)]))
                put(after, want[s], (c + 2 + more, a + "R", [*w, ({"u": "user", "a": "assistant"}[want[s]], text)]))
        best = after
    best = inserted(best)
    return min(best[s] for s in ("", "a") if s in best)


def plain_report13(table, damage=True):
    """The contract's rows from (conv_id, turn, role, text) tuples."""
    shown = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in table]
    kept = defaultdict(list)
    for c, t, r, x in shown:
        n = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damage else 9
        rows = kept[c]
        if n == 0:
            continue
        x = "" if n == 1 else re.sub("[.!?]", "", x) if n == 2 else x
        rows += [(t, "user" if n == 4 else r, x)] * (2 if n == 3 else 1)
    out = {}
    for c, rows in kept.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, marked, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        for i, (_, r, x) in enumerate(rows):
            bare = x.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (r, x) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((r, x))
            marked.append((r, x, fault))
            if fault:
                count[fault] += 1
            if i and rows[i - 1][1][:1] + r[:1] not in ("su", "ua", "au"):
                count["illegal"] += 1
        cost, audit, written = plain_repair(marked)
        sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in written).encode()).hexdigest()
        out[c] = (c, gaps, *count.values(), cost, audit, sha)
    return out


def test_auction_equals_dynamic_programming():
    rng = random.Random(4)
    names = {CR.SYSTEM: "system", CR.USER: "user", CR.ASSISTANT: "assistant", CR.OTHER: "tool"}
    faults = [None, "blank", "duplicate", "truncated"]
    for t in range(1500):
        n = rng.randrange(0, 8) if t < 1400 else rng.randrange(30, 120)
        rows = [(rng.randrange(4) if rng.random() < 0.3 else 1 + i % 2, rng.choice([0, 0, 0, 1, 2, 3])) for i in range(n)]
        cost, audit, _ = plain_repair([(names[c], "x", faults[f]) for c, f in rows])
        assert CR.audit_codes("".join(CR.row_code(*r) for r in rows))[4:] == (cost, audit)


def test_long_conversations_are_solved_window_by_window():
    rng = random.Random(6)
    codes = "".join(CR.row_code(rng.choice([0, 1, 2, 3]), rng.choice([0, 0, 1, 3])) for _ in range(5000))
    assert CR._solve(codes)[0] > 0
    whole, CR.WINDOW = CR.WINDOW, 7
    try:
        small = CR._solve(codes)
    finally:
        CR.WINDOW = whole
    assert CR._solve(codes) == small


def test_repair_query_whole_table(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        table = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
                 .select("conv_id", "turn", "role", "text").collect()]
        got = {r.conv_id: tuple(r) for r in queries.op13_conversation_repair(spark, sf).collect()}
        assert got == plain_report13(table)


def odd_conversations():
    rng = random.Random(9)
    rows = [(1, None, "user", "no turn."), (1, None, None, "no role."), (1, 3, "assistant", None), (2, 1, "", "empty role."),
            (2, 1, "", "empty role."), (2, 5, "üser", "é?"), (None, 1, "user", "no id!"), (None, None, None, None),
            (3, 2, "system", "only."), (4, -5, "assistant", "first."), (4, 1 << 40, "user", "x" * 200_000)]
    rows += [(5, 7, "user", "the same again.")] * 40
    rows += [(6, t, "user", "the same again.") for t in range(0, 5000, 3)]
    rows += [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "", f"t{t}!", "c?"]))
             for t in range(-30, 2500)]
    rows += [(c, t, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice(["a.", "b", " \n", None, "c? \t"]))
             for c in range(20, 60) for t in range(rng.randrange(1, 9)) for _ in range(rng.randrange(1, 3))]
    return rows


def test_repair_odd_rows(spark):
    table = odd_conversations()
    df = spark.createDataFrame([(*r, "k", "a", 1) for r in table],
                               "conv_id long, turn long, role string, text string, _key string, audit string, h int").repartition(4)
    for rows, damage in ((CR.damaged(df), True), (df, False)):
        got = {r.conv_id: tuple(r) for r in CR.repair_report(rows, df.select("conv_id")).collect()}
        assert got == plain_report13(table, damage)
    assert CR.repair_report(df.limit(0)).collect() == []
    none_left = spark.createDataFrame([(5, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    row = CR.repair_report(none_left.limit(0), none_left.select("conv_id")).first()
    assert tuple(row) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_rows_fit_the_pattern(spark):
    df = spark.createDataFrame(odd_conversations(), "conv_id long, turn long, role string, text string")
    digest = {r.conv_id: r for r in CR.repair_report(df).collect()}
    written = defaultdict(list)
    for r in CR.repaired_rows(df).orderBy("conv_id", "place").collect():
        assert r.place == len(written[r.conv_id])
        written[r.conv_id].append(r)
    for c, report in digest.items():
        rows = written.get(c, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in rows))
        assert "".join(r.edit for r in rows) == report.audit.replace("D", "")
        text = "\n".join(f"{r.role}:{r.text}" for r in rows)
        assert hashlib.sha256(text.encode()).hexdigest() == report.repaired_sha256


def test_no_text_is_gathered_per_conversation(spark):
    """Row codes are all that meets per conversation: no collect_list takes a text."""
    df = spark.createDataFrame(odd_conversations(), "conv_id long, turn long, role string, text string")
    plan = CR.repair_report(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan and not re.search(r"collect_list\([^)]*text", plan)

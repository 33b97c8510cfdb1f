"""Packing, filter audit and spelling variants against brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from contentlake.llm import filter_audit, packing, spelling
from contentlake.llm.token_output import WordEncoder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, length long, word string, n long"


def prose(seed: int, n: int, kinds: int = 60) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{'aeiou'[x % 5]}word{'bcdfg'[x % 7 % 5]}x{x}" for x in rng.integers(0, kinds, n))


def odd_rows() -> list[tuple]:
    texts = [None, "", " \n\t", "One", "Ärger é 漢字 naïve", prose(1, 400), prose(1, 400), prose(2, 120, 5000), prose(3, 9000), "SHOUT " * 30,
             prose(4, 150, 5000) + " $5", "A1 " * 4000, prose(5, 90), prose(1, 400), "", "tab\tand\x0bfeed\x0c end\r\n", "x" * 30_000]
    rows = [(i, t, ("en", "de", None, "", "fr")[i % 5], 7, "clash", 1) for i, t in enumerate(texts)]
    return [*rows, (None, prose(1, 400), "en", 7, "c", 1), (None, "null id", None, 7, "c", 1), (None, "null id", None, 7, "c", 1),
            (5, prose(1, 400), "en", 7, "c", 1), (8, "other text of row eight", "en", 7, "c", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- Packing ---------------------------------------------------------------------------------


def fewest(pieces: tuple[int, ...], capacity: int) -> int:
    """Least number of sequences, by search over all of them."""

    @lru_cache(None)
    def need(left: tuple[int, ...]) -> int:
        if not left:
            return 0
        first, rest, best = left[0], left[1:], len(left)

        def fill(at: int, room: int, kept: tuple[int, ...]) -> None:
            nonlocal best
            if at == len(rest):
                best = min(best, 1 + need(kept))
                return
            if rest[at] <= room:
                fill(at + 1, room - rest[at], kept)
            fill(at + 1, room, (*kept, rest[at]))

        fill(0, capacity - first, ())
        return best

    return need(tuple(sorted(pieces, reverse=True)))


def test_reduction_keeps_the_optimum():
    rnd = random.Random(3)
    n_fixed = 0
    for _ in range(400):
        capacity = rnd.choice((10, 17, 30))
        low = rnd.choice((1, capacity // 5, capacity // 3))
        pieces = tuple(rnd.randint(max(1, low), capacity) for _ in range(rnd.randint(1, 9)))
        of = packing.Instance(capacity, dict(Counter(pieces)))
        fixed = packing.reduce_instance(of)
        rest = tuple(x for x, c in of.counts.items() for _ in range(c))
        used = Counter(x for s, times in fixed for x in s * times)
        assert used + Counter(rest) == Counter(pieces)
        assert all(sum(s) <= capacity for s, _ in fixed)
        assert sum(t for _, t in fixed) + fewest(rest, capacity) == fewest(pieces, capacity), pieces
        n_fixed += sum(t for _, t in fixed)
    assert n_fixed > 300


def unrolled(plan: packing.Plan, counts: dict[int, int]) -> dict[int, list[tuple[int, int]]]:
    out, seen = defaultdict(list), Counter()
    for length, first, sequence, each, offset in plan.entries:
        after = [e[1] for e in plan.entries if e[0] == length and e[1] > first]
        for k in range((min(after) if after else counts[length]) - first):
            out[sequence + k // each].append((offset + k % each * length, length))
            seen[length] += 1
    assert seen == Counter(counts)
    return out


def test_plans_are_whole_and_tight():
    rnd = random.Random(9)
    for trial in range(60):
        capacity = rnd.choice((16, 100, 4096))
        top = capacity if trial % 2 else max(2, capacity // 6)
        counts = Counter(rnd.randint(1, top) for _ in range(rnd.randint(1, 300)))
        counts = {x: c * rnd.choice((1, 1, 7)) for x, c in counts.items()}
        plan = packing.plan_for(counts, capacity)
        of = unrolled(plan, counts)
        assert sorted(of) == list(range(plan.sequences))
        for pieces in of.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= capacity
        # Best fit of falling lengths needs at most 11/9 of the optimum and one more.
        least = -(-sum(x * c for x, c in counts.items()) // capacity)
        over = sum(c for x, c in counts.items() if 2 * x > capacity)
        assert plan.sequences <= 11 / 9 * max(least, over) * 1.25 + 1
    huge = packing.plan_for({x: 10**9 + x for x in range(1, 4097)})
    assert len(huge.entries) < 30_000 and huge.sequences >= sum(x * (10**9 + x) for x in range(1, 4097)) / 4096


@pytest.mark.parametrize("capacity", [4096, 50])
def test_pack(docs, empty, capacity):
    packed = packing.pack(docs, VOCABULARY, capacity=capacity, with_ids=True)
    got = packed.collect()
    tok = WordEncoder(VOCABULARY).tokenizer
    want = Counter()
    for r in odd_rows():
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [packing.END_ID]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[r[0], k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert want == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"], bytes(r["ids"])))
    for pieces in by.values():
        at = 0
        for offset, length, _ in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    rows = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    assert rows.keys() == by.keys()
    for i, pieces in by.items():
        assert bytes(rows[i]["ids"]) == b"".join(x[2] for x in sorted(pieces)) and len(rows[i]["ids"]) == 4 * rows[i]["n_tokens"]
    assert packing.pack(empty, VOCABULARY).count() == 0


# --- Filter audit ----------------------------------------------------------------------------


def failed(text: str) -> set[str]:
    words = text.encode().split()
    out = {"A"} if len(words) < 100 else set()
    if 100 * len(set(words)) < 80 * len(words):
        out.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
        out.add("C")
    return out | ({"D"} if set(text) & set("#$%&*|") else set())


def brute_audit(rows: list[tuple], labels: list[tuple]) -> dict:
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    marked = []
    for i, t, lang, *_ in rows:
        t = t or ""
        copy = t in least and (i is None or least[t] < i)
        marked.append((lang or "", failed(t) | ({"E"} if copy else set()), i in good, i in toxic))
    out, shapley = {}, Counter()
    for part in {m[0] for m in marked}:
        for order in permutations("ABCDE"):
            here, gone = [m for m in marked if m[0] == part], []
            for step, f in enumerate(order, 1):
                lost = [m for m in here if f in m[1]]
                here = [m for m in here if f not in m[1]]
                out[part, "".join(order), step] = [
                    len(here), len(lost), sum(f in m[1] for m in gone),
                    sum(m[1] == {f} for m in marked if m[0] == part), sum(m[2] for m in lost), sum(m[3] for m in lost)]
                shapley[part, f] += len(lost)
                gone += lost
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


LABELS = [(5, 1, 0), (6, 0, 1), (7, 1, 1), (7, 0, 0), (13, 1, 0), (None, 1, 1), (99, 1, 1), (8, None, 1), (3, 1, None)]


def test_audit(spark, docs, empty):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, labels)
    assert got.columns == ["part", "filter_order", "step", *filter_audit._COUNTS]
    rows = {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()}
    assert rows == brute_audit(odd_rows(), LABELS) and len(rows) == 600 * 4
    assert filter_audit.audit(empty, labels).count() == 0
    assert filter_audit.audit(docs, labels.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


def test_audit_sql():
    rows = [r for r in odd_rows() if r[0] is not None]  # SQL has null smallest in no order
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [r[:3] for r in rows])
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", LABELS)
    got = con.execute(filter_audit.ORACLE_SQL).fetchall()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == brute_audit(rows, LABELS)


def test_audit_of_a_hot_text(spark):
    """Many copies over parts and ids, most of them of one text."""
    rows = [(i * 7 % 500, "same text" if i % 3 else f"text {i % 40}", ("en", "de")[i % 2]) for i in range(500)]
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 500, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    of = spark.createDataFrame([(i, q, int(t)) for i, q, t in labels], "doc_id long, quality int, toxic int")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audit(df, of).collect()}
    assert got == brute_audit(rows, labels)


# --- Spelling variants -----------------------------------------------------------------------


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :]
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def brute_variants(rows: list[tuple], drop_every: int = 31, ratio: int = 10) -> dict:
    import regex

    said = Counter()
    for i, text, *_ in rows:
        for run in regex.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % drop_every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            said[run] += 1
    words = {w: n for w, n in said.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, of in near.items():
        best = min(of, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def spelt_rows() -> list[tuple]:
    rng = random.Random(4)
    syllables = ["ka", "lo", "mi", "ré", "Stra", "ßen", "tion", "ver", "ñu", "qu"]
    base = ["".join(rng.choice(syllables) for _ in range(rng.randint(3, 5))) for _ in range(80)]
    rows = []
    for i in range(300):
        said = []
        for _ in range(rng.randint(0, 120)):
            w = base[min(int(rng.expovariate(0.07)), 79)]
            if rng.random() < 0.2:
                at = rng.randrange(len(w) + 1)
                w = (w[:at] + rng.choice("xyzÀ") + w[at:], w[:at] + w[at + 1 :], w[:at] + "q" + w[at + 1 :])[rng.randrange(3)]
            said.append(w if rng.random() < 0.9 else w.upper())
        rows.append((i if i % 9 else None, " ".join(said) + rng.choice((".", " 漢字", " don't-stop", ""))))
    return [*rows, (1, None), (2, ""), (3, "abcdefg" * 4000 + " " + "abcdefg" * 4000 + "h"), (4, "abcdefg" * 4000 + " " + "abcdefg" * 4000 + "h"), rows[5], rows[5]]


@pytest.mark.parametrize("drop_every", [31, 4])
def test_variants(spark, empty, drop_every):
    rows = spelt_rows()
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, n long, word string").repartition(5)
    got = {r["word"]: tuple(r)[1:] for r in spelling.variants(df, drop_every=drop_every).collect()}
    want = brute_variants(rows, drop_every)
    assert got == want
    assert sum(v[0] is not None for v in want.values()) > 50
    assert spelling.variants(empty).count() == 0


def test_near_pairs_of_all_edits(spark):
    """Every edit at every place of words of 7 to 12 letters is found, also where letters repeat."""
    rng, words = random.Random(1), set()
    for length in range(7, 13):
        for letters in ("ab", "abcdefghé"):
            w = "".join(rng.choice(letters) for _ in range(length))
            words.add(w)
            for at in range(length + 1):
                words |= {w[:at] + "a" + w[at:], w[:at] + "z" + w[at:], w[:at] + "é" + w[at + 1 :], w[:at] + w[at + 1 :]}
    words = sorted(w for w in words if len(w) >= 7)
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = Counter(tuple(sorted((r["a"], r["b"]))) for r in spelling.near_pairs(df).collect())
    want = Counter((a, b) for k, a in enumerate(words) for b in words[k + 1 :] if one_edit(a, b))
    assert got == want


def test_roots_of_long_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(18)] + [(f"leaf{i}", "w3") for i in range(50)]
    df = spark.createDataFrame(chain, "word string, form string")
    assert {r["root"] for r in spelling.roots(df).collect()} == {"w18"}
    assert spelling.roots(df.limit(0)).count() == 0

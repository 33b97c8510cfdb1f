"""Secrets by fixed patterns, and by a small character network over every other candidate.

The patterns (base) always count. A candidate is any run of at least 8 characters of
[A-Za-z0-9+/_=-]. The network, a convolution over character embeddings with max and mean pooling
written in numpy, scores every part of it wherever it stands, together with its surroundings. Equal
parts in equal surroundings are scored once for some texts together.

It is trained on labelled findings: candidates inside a base match are positive, others
negative, among them numbers and ordinary words (of these, which are nearly all runs there are, one in
_PLAIN_EVERY is a finding). A first network is fitted on `max_labelled` of each kind, the smallest by a hash.
From it the training goes on over all findings: they are dealt by a hash into buckets of
bounded size, each bucket goes through every one of its rows, and the weights are averaged. So that secrets
are learnt and not the patterns' keywords, in most of the positives the surroundings are
blanked or taken from a negative, and most of their values are drawn anew from the alphabets secrets
are written in. All findings of a held-out fifth of the values, varied in the same way and all in the
surroundings of negatives, calibrate the scores and set the threshold, the highest that keeps the recall.

Defined cases: a null or empty text has no spans; rows with equal ids are scanned each; with
too few labelled candidates nothing is added to the base; an empty table gives no rows.
Texts are scanned whole; a long candidate is scored part by part and counts by its best part.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentlake.llm.common import staged

#: The kinds in their order, with their patterns and least lengths.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run shorter than 24 fails, and runs are maximal
KINDS = ("assign", "access", "hex", "learnt")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
_TELLING = re.compile(r"[0-9]|[a-z][A-Z]")
BEFORE, INSIDE, AFTER = 20, 32, 8
WIDTH = BEFORE + INSIDE + AFTER
MAX_LABELLED = 3000
RECALL = 0.98
_LEAST_LABELLED = 10
_PLAIN_EVERY = 64
_COPIES = 20
_WARM_UP, _TRUST = 400, 0.8
_STEPS, _RATE, _LEAST_STEPS = 1500, 0.003, 400
_A_BUCKET, _OF_A_SIDE = 50_000, 50  # findings of a bucket, and how many of them are at least (expected) of either label
_BINS = 1024  # held-out logits are counted by multiples of 1 / _BINS
_LARGEST = 64  # logits beyond it are counted as it
_TEXTS = 1000  # texts whose candidates are held at a time
_SCORED = 128  # contexts scored together, few enough for the processor's cache
POSITIVE, TELLING, PLAIN = range(3)
_SHARES = {POSITIVE: 32, TELLING: 32, PLAIN: 64}  # rows of a kind in one step over all findings


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by start, then kind."""
    out = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def contexts(text: str, a: int, b: int) -> Iterator[str]:
    """The parts of a candidate with their surroundings, one for every INSIDE characters."""
    for at in range(a, b, INSIDE):
        inside = text[at : min(at + INSIDE, b)]
        left = text[max(0, at - BEFORE) : at].rjust(BEFORE, "\0")
        yield left + inside.ljust(INSIDE, "\0") + text[at + len(inside) : at + len(inside) + AFTER].ljust(AFTER, "\0")


def labelled(text: str, seed: int) -> Iterator[tuple[int, int, str]]:
    """(kind, order, context) of the candidates to learn from: all in base matches, all others with a digit
    or a change of case, and one in _PLAIN_EVERY of the rest, by a hash."""
    spans = base_spans(text)
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        h = zlib.crc32(m.group().encode(), seed)
        if any(s < b and a < e for _, s, e in spans):
            kind = POSITIVE
        elif _TELLING.search(m.group()):
            kind = TELLING
        elif h % _PLAIN_EVERY == 0:
            kind = PLAIN
        else:
            continue
        for k, context in enumerate(contexts(text, a, b)):
            yield kind, h + k, context


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def findings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(kind, o, context, held) of the candidates to learn from. `held` is by value, so that one value is not on both
    sides."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [x for seed, t in zip(pdf["seed"], pdf["text"]) for x in labelled(t, seed)]
            out = pd.DataFrame(rows, columns=["kind", "o", "context"])
            yield out.assign(held=held_out(out["context"].tolist()))

    rows = docs.select(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("seed"), _text(text_col))
    return rows.mapInPandas(run, "kind int, o long, context string, held boolean")


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit("")).alias("text")


def _codes(contexts: list[str]) -> np.ndarray:
    """Printable ASCII as 1 to 95, the rest and the padding as 0."""
    raw = np.frombuffer("".join(contexts).encode("utf-32-le"), "<u4").reshape(-1, WIDTH).astype(np.int64)
    return np.where((raw >= 32) & (raw < 127), raw - 31, 0)


def held_out(contexts: list[str]) -> np.ndarray:
    """The contexts whose value, the part inside, belongs to the held-out fifth."""
    inside = _codes(contexts)[:, BEFORE : BEFORE + INSIDE].astype(np.uint8)
    return np.array([zlib.crc32(x.tobytes()) % 5 == 0 for x in inside], bool)


#: Codes of the letters that values of secrets are written in: hexadecimal, base 32, 36, 62 and 64.
_ALPHABETS = [
    _codes([x.ljust(WIDTH, "\0")[:WIDTH]])[0, : min(len(x), WIDTH)]
    for x in ("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyz0123456789")
]
_ALPHABETS.append(np.concatenate([np.arange(17, 27), np.arange(34, 60), np.arange(66, 92)]))
_ALPHABETS.append(np.append(_ALPHABETS[-1], _codes(["+/_=".ljust(WIDTH, "\0")])[0, :4]))


class CharNet:
    """Embedding, one convolution, max and mean pooling, a logistic unit."""

    def __init__(self, seed: int = 7, dim: int = 8, width: int = 5, filters: int = 24):
        rng = np.random.default_rng(seed)
        self.width = width
        self.w = {
            "emb": rng.normal(0, 0.3, (96, dim)),
            "conv": rng.normal(0, 0.2, ((dim + 1) * width, filters)),
            "conv_b": np.zeros(filters),
            "out": rng.normal(0, 0.2, 2 * filters),
            "out_b": np.zeros(1),
        }
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        self.scale, self.shift, self.threshold = 1.0, 0.0, np.inf
        inside = np.zeros(WIDTH, np.float32)
        inside[BEFORE : BEFORE + INSIDE] = 1
        self.inside = inside
        self.outside = np.flatnonzero(inside == 0)

    def _forward(self, codes: np.ndarray):
        x = self.w["emb"][codes]
        flag = np.broadcast_to(self.inside[None, :, None], (*codes.shape, 1))
        x = np.concatenate([x, flag], axis=2)
        wide = np.concatenate([x[:, i : WIDTH - self.width + 1 + i] for i in range(self.width)], axis=2)
        act = np.maximum(wide @ self.w["conv"] + self.w["conv_b"], 0)
        best = act.argmax(axis=1)
        pooled = np.concatenate([act.max(axis=1), act.mean(axis=1)], axis=1)
        return wide, act, best, pooled, pooled @ self.w["out"] + self.w["out_b"][0]

    def logits(self, codes: np.ndarray) -> np.ndarray:
        """As `_forward`, with the convolution's share of each character at each of its places looked up."""
        dim, filters = self.w["emb"].shape[1], len(self.w["conv_b"])
        steps = WIDTH - self.width + 1
        conv = self.w["conv"].reshape(self.width, dim + 1, filters)
        share = np.einsum("cd,kdf->kcf", self.w["emb"], conv[:, :dim])
        flags = np.stack([self.inside[k : k + steps] for k in range(self.width)], axis=1)
        fixed = (flags @ conv[:, dim] + self.w["conv_b"])[:, None, :]
        of_max, of_mean = self.w["out"][:filters], self.w["out"][filters:] / steps
        out = [np.empty(0)]
        for i in range(0, len(codes), _SCORED):
            x = codes[i : i + _SCORED].T
            act = share[0][x[:steps]] + fixed
            for k in range(1, self.width):
                act += share[k][x[k : k + steps]]
            np.maximum(act, 0, out=act)
            out.append(act.max(axis=0) @ of_max + act.sum(axis=0) @ of_mean + self.w["out_b"][0])
        return np.concatenate(out)

    def chances(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(codes) + self.shift, -40, 40)))

    def _gradient(self, codes: np.ndarray, label: np.ndarray, weight: np.ndarray, trust: float) -> dict[str, np.ndarray]:
        """Negatives scored above `trust` are left out: they are likely secrets that no pattern has labelled."""
        wide, act, best, pooled, z = self._forward(codes)
        n, steps, filters = act.shape
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        dz = (np.where((label == 0) & (p > trust), 0, p - label) * weight).astype(np.float32)
        g = {"out": pooled.T @ dz, "out_b": np.array([dz.sum()])}
        dp = dz[:, None] * self.w["out"][None, :]
        da = np.repeat(dp[:, None, filters:] / steps, steps, axis=1)
        da[np.arange(n)[:, None], best, np.arange(filters)[None, :]] += dp[:, :filters]  # each place once
        da *= act > 0
        flat = da.reshape(-1, filters)
        g["conv"] = wide.reshape(len(flat), -1).T @ flat
        g["conv_b"] = flat.sum(axis=0)
        dwide = (flat @ self.w["conv"].T).reshape(n, steps, -1)
        dim = self.w["emb"].shape[1]
        dx = np.zeros((*codes.shape, dim), np.float32)
        for i in range(self.width):
            dx[:, i : i + steps] += dwide[:, :, i * (dim + 1) : i * (dim + 1) + dim]
        letters, dx = codes.ravel(), dx.reshape(-1, dim)
        g["emb"] = np.stack([np.bincount(letters, dx[:, d], len(self.w["emb"])) for d in range(dim)], axis=1)
        return g

    def _varied(self, codes: np.ndarray, label: np.ndarray, pick: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Rows `pick` with other surroundings, and values as other kinds of secrets have them."""
        x, of = codes[pick].copy(), label[pick] > 0
        negatives, positives = np.flatnonzero(label == 0), np.flatnonzero(label > 0)
        r = rng.random(len(pick))
        out = self.outside
        x[np.ix_(r < 0.35, out)] = 0
        for moved, source in ((of & (r >= 0.35) & (r < 0.8), negatives), (~of & (r >= 0.35) & (r < 0.6), positives)):
            take = source[rng.integers(0, len(source), moved.sum())]
            x[np.ix_(moved, out)] = codes[np.ix_(take, out)]
        for i in np.flatnonzero(rng.random(len(pick)) < np.where(of, 0.7, 0.3)):
            value = x[i, BEFORE : BEFORE + INSIDE]
            n = int((value > 0).sum())
            if of[i]:
                # Drawn anew from an alphabet that secrets have; of some the beginning stays.
                letters = _ALPHABETS[rng.integers(0, len(_ALPHABETS))]
                keep = int(rng.integers(0, 6)) if rng.random() < 0.3 else 0
                n = int(rng.integers(min(n, 12), n + 1))
                value[keep:n] = letters[rng.integers(0, len(letters), max(n - keep, 0))]
                value[n:] = 0
            elif rng.random() < 0.5:
                value[:] = np.where((value >= 66) & (value <= 91), value - 32, value)  # in capitals
            else:
                digits = (value >= 17) & (value <= 26)
                value[digits] = rng.integers(17, 27, digits.sum())
        return x

    def fit(
        self, codes: np.ndarray, label: np.ndarray, picks: Iterator[tuple[np.ndarray, np.ndarray, float]], warm_up: int,
        rng: np.random.Generator,
    ) -> CharNet:
        """A step for each of `picks`: rows, their weights and the step's rate."""
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        for t, (pick, weight, rate) in enumerate(picks, 1):
            trust = 1.0 if t <= warm_up else _TRUST
            for k, g in self._gradient(self._varied(codes, label, pick, rng), label[pick], weight, trust).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                step = first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
                self.w[k] = (self.w[k] * (1 - 1e-4) - rate * step).astype(np.float32)
        return self

    def fit_first(self, codes: np.ndarray, label: np.ndarray, seed: int = 7) -> CharNet:
        """As many positives as negatives in each step, however many there are of either."""
        rng = np.random.default_rng(seed)
        sides = [np.flatnonzero(label == v) for v in (0, 1)]
        weight = np.full(64, 1 / 64)
        picks = ((np.concatenate([s[rng.integers(0, len(s), 32)] for s in sides]), weight, _RATE) for _ in range(_STEPS))
        return self.fit(codes, label, picks, _WARM_UP, rng)

    def fit_all(self, codes: np.ndarray, kind: np.ndarray, seed: int = 7) -> CharNet:
        """Steps in which every row has its turn; see `every_row`."""
        rng = np.random.default_rng(seed)
        return self.fit(codes, (kind == POSITIVE).astype(float), every_row(kind, rng), 0, rng)

    def held_logits(self, codes: np.ndarray, label: np.ndarray, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
        """Logits of held-out rows: of _COPIES of each positive, varied as in training and in the surroundings of
        negatives, and of the negatives."""
        rng = np.random.default_rng(seed)
        negatives = np.flatnonzero(label == 0)
        ones = np.repeat(np.flatnonzero(label > 0), _COPIES)
        if not len(negatives):
            return np.empty(0), np.empty(0)
        positive = self._varied(codes, label, ones, rng)
        positive[:, self.outside] = codes[np.ix_(negatives[rng.integers(0, len(negatives), len(ones))], self.outside)]
        return self.logits(positive), self.logits(codes[negatives])

    def calibrate(self, z: np.ndarray, of_ones: np.ndarray, of_negatives: np.ndarray, recall: float) -> CharNet:
        """Platt scaling on held-out logits, `z` in order with how many positives and negatives have each; then
        the highest threshold (of the logit) that keeps `recall` of the positives."""
        n, m, a, b = of_ones.sum(), of_negatives.sum(), 1.0, 0.0
        many = of_ones + of_negatives
        aim = (of_ones * (n + 1) / (n + 2) + of_negatives / (m + 2)) / many
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
            w = (p * (1 - p) + 1e-6) * many
            h = np.array([[(w * z * z).sum() + 1, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
            off = (p - aim) * many
            da, db = np.linalg.solve(h, [(off * z).sum() + (a - 1), off.sum()])
            a, b = float(np.clip(a - da, 0.05, 5)), float(np.clip(b - db, -20, 20))
        self.scale, self.shift = a, b
        self.threshold = float(z[np.searchsorted(np.cumsum(of_ones), int((1 - recall) * n), "right")])
        return self


def every_row(kind: np.ndarray, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Rows of each step, their weights and the rate, which falls to none: _SHARES of each kind, and as many steps as the
    kind that needs most takes to go through all its rows, or _LEAST_STEPS; the others start over. All positives
    of a step weigh as much as its negatives."""
    rows = {k: np.flatnonzero(kind == k) for k in _SHARES}
    rows = {k: r for k, r in rows.items() if len(r)}
    if POSITIVE not in rows or len(rows) < 2:
        return
    steps = max(_LEAST_STEPS, *[-(-len(r) // _SHARES[k]) for k, r in rows.items()])
    order = []
    for k, r in rows.items():
        n = steps * _SHARES[k]
        order.append(np.concatenate([rng.permutation(r) for _ in range(-(-n // len(r)))])[:n].reshape(steps, -1))
    n_negative = sum(_SHARES[k] for k in rows if k != POSITIVE)
    weight = np.repeat([0.5 / _SHARES[POSITIVE], 0.5 / n_negative], [_SHARES[POSITIVE], n_negative])
    for t, pick in enumerate(np.concatenate(order, axis=1)):
        yield pick, weight, _RATE * (1 - t / steps)


def _dealt(found: DataFrame, sizes: dict[bool, int]) -> DataFrame:
    """All of `found`, (label, rows) in `sizes`, in buckets by a hash of the row. Of a label that is too rare for
    each bucket to have some, rows are in several buckets."""
    n = -(-sum(sizes.values()) // _A_BUCKET)
    copies = {label: max(1, -(-_OF_A_SIDE * n // rows)) for label, rows in sizes.items()}
    last = F.when(F.col("kind") == POSITIVE, F.lit(copies[True] - 1)).otherwise(F.lit(copies[False] - 1))
    copied = found.withColumn("copy", F.explode(F.sequence(F.lit(0), last)))
    return copied.withColumn("bucket", F.pmod(F.xxhash64("o", "context", "copy"), F.lit(n)).cast("int"))


def _in_order(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Codes and kinds of a bucket's rows, in an order that is the same however they came."""
    pdf = pdf.sort_values(["o", "context", "kind", "copy"])
    return _codes(pdf["context"].tolist()), pdf["kind"].to_numpy()


def _trained_on_all(net: CharNet, dealt: DataFrame) -> CharNet:
    """`net` after a pass over all findings that are not held out: each bucket goes on from it, and the weights they
    end with are averaged by the rows they have seen."""
    shapes = {k: v.shape for k, v in net.w.items()}

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        codes, kind = _in_order(pdf)
        own = CharNet()
        own.w = dict(net.w)
        own.fit_all(codes, kind)
        flat = np.concatenate([own.w[k].ravel() for k in shapes]).astype(float)
        return pd.DataFrame({"n": [len(kind)], "w": [flat]})

    ends = dealt.where("NOT held").groupBy("bucket").applyInPandas(learn, "n long, w array<double>")
    mean = ends.select("n", F.posexplode("w").alias("at", "x")).groupBy("at").agg(F.sum(F.col("n") * F.col("x")) / F.sum("n"))
    flat = np.array([x for _, x in sorted(tuple(r) for r in mean.collect())], np.float32)
    out = CharNet()
    ends_at = np.cumsum([int(np.prod(s)) for s in shapes.values()])
    out.w = {k: x.reshape(s) for (k, s), x in zip(shapes.items(), np.split(flat, ends_at[:-1]))}
    return out


def _calibrated_on_all(net: CharNet, dealt: DataFrame, recall: float) -> CharNet:
    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        codes, kind = _in_order(pdf)
        z = net.held_logits(codes, (kind == POSITIVE).astype(float))
        out = pd.DataFrame({"z": np.concatenate(z), "one": np.repeat([1, 0], [len(x) for x in z])})
        out["z"] = np.floor(out["z"].clip(-_LARGEST, _LARGEST) * _BINS)
        counted = out.groupby("z")["one"].agg(["sum", "size"]).reset_index()
        return pd.DataFrame({"z": counted["z"], "ones": counted["sum"], "n": counted["size"]})

    scored = dealt.where("held").groupBy("bucket").applyInPandas(score, "z double, ones long, n long")
    counts = scored.groupBy("z").agg(F.sum("ones"), F.sum("n")).collect()  # at most 2 x _LARGEST x _BINS + 1 rows
    z, ones, n = np.array(sorted(tuple(r) for r in counts), float).reshape(-1, 3).T
    if not ones.sum():
        return net  # the threshold stays infinite
    return net.calibrate(z / _BINS, ones, n - ones, recall)


def train(found: DataFrame, max_labelled: int = MAX_LABELLED, recall: float = RECALL) -> CharNet | None:
    """The network trained and calibrated on all labelled candidates, or None if there are too few. `max_labelled`
    bounds what the first network, from which the training goes on, is fitted on."""
    sizes = {(r["one"], r["held"]): r["n"] for r in found.groupBy((F.col("kind") == POSITIVE).alias("one"), "held").agg(F.count("*").alias("n")).collect()}
    of_label = {one: sum(n for (o, _), n in sizes.items() if o == one) for one in (True, False)}
    if min(of_label.values()) < _LEAST_LABELLED or len(sizes) < 4:
        return None
    sample = []
    for kind in (POSITIVE, TELLING, PLAIN):
        of_kind = found.where((F.col("kind") == kind) & ~F.col("held")).orderBy("o", "context").limit(max_labelled)
        sample += [(r["context"], float(kind == POSITIVE)) for r in of_kind.collect()]
    net = CharNet().fit_first(_codes([c for c, _ in sample]), np.array([one for _, one in sample]))
    dealt = _dealt(found, of_label)
    return _calibrated_on_all(_trained_on_all(net, dealt), dealt, recall)


class Scanner:
    """Base spans and what the network adds."""

    def __init__(self, net: CharNet | None):
        self.net = net

    def _above(self, found: list[str]) -> dict[str, bool]:
        """Of different contexts those that reach the threshold."""
        above: dict[str, bool] = {}
        for i in range(0, len(found), _SCORED * 64):
            part = found[i : i + _SCORED * 64]
            above.update(zip(part, (self.net.logits(_codes(part)) >= self.net.threshold).tolist()))
        return above

    def scan(self, texts: list[str]) -> list[tuple[list, list]]:
        base = [base_spans(t) for t in texts]
        if self.net is None:
            return [(spans, []) for spans in base]
        rows, parts = [], []
        for i, (t, spans) in enumerate(zip(texts, base)):
            for m in CANDIDATE.finditer(t):
                a, b = m.span()
                if not any(s < b and a < e for _, s, e in spans):
                    for context in contexts(t, a, b):
                        rows.append((i, a, b))
                        parts.append(context)
        above = self._above(list(dict.fromkeys(parts)))
        added = [set() for _ in texts]
        for (i, a, b), context in zip(rows, parts):
            if above[context]:
                added[i].add((KINDS.index("learnt"), a, b))
        return [(spans, sorted(more)) for spans, more in zip(base, added)]


def _scored(rows: DataFrame, net: CharNet | None) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(net)
        for pdf in batches:
            out = []
            texts = pdf["text"].tolist()
            for spans, added in (x for i in range(0, len(texts), _TEXTS) for x in scanner.scan(texts[i : i + _TEXTS])):
                every = sorted(spans + added, key=lambda s: (s[1], s[0]))
                kinds = [s[0] for s in spans]
                digest = hashlib.sha256(spans_text(spans).encode()).hexdigest()
                out.append((kinds.count(0), kinds.count(1), kinds.count(2), len(added), digest, spans_text(every)))
            res = pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "n_learnt", "base_sha256", "spans"])
            res.insert(0, "id", pdf["id"].to_numpy())
            yield res

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(
        run, f"id {kind}, n_assign long, n_access long, n_hex long, n_learnt long, base_sha256 string, spans string"
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_labelled: int = MAX_LABELLED,
    recall: float = RECALL,
) -> DataFrame:
    """(`id_col`, n_assign, n_access, n_hex, n_learnt, base_sha256, spans) for every row."""
    net = train(staged(findings(docs, id_col, text_col), "findings"), max_labelled, recall)
    return _scored(docs.select(F.col(id_col).alias("id"), _text(text_col)), net).withColumnRenamed("id", id_col)

"""Personal data by rules and by boosted trees over proposed spans.

The base rules always count. Beside them, generators with high recall propose overlapping spans
(anything like an address, a group of digits, a key); each gets features of its format and of the
characters around it. Boosted trees are fitted on all of the corpus' own proposals, with
labels from strict checks (a base rule or a known key format holds; or it is plainly prose or a
short number); base addresses rewritten in the forms that hide them are learned too. A threshold per family, calibrated on the part of the proposals kept apart, selects what
is redacted in addition.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from musterline.llm.text_hashing import slices, with_fields
from musterline.session import written

KINDS = ("email", "ip", "card", "phone")
#: Further kinds that only the method reports; in results they come after KINDS.
MORE_KINDS = ("secret",)
#: No longer a bound: the trees are fitted on every distinct labelled span.
SAMPLE_SPANS = 20_000
#: Precision that a threshold must have on the part of the sample kept apart.
PRECISION = 0.995
TREES, DEPTH, RATE, BINS = 30, 3, 0.3, 32
#: Labelled spans per part while the trees are fitted.
LEARN_PART = 200_000

#: An address from its sign on; its name is the run of NAME characters before, so each is looked at once.
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NAME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
#: No match begins within a run of digits: it would have begun with the run.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: What the generators look for, by family.
PROPOSED = {
    "email": re.compile(r" ?(?:@|[\[(] ?at ?[\])]) ?[^\s@,;:<>\"]+(?: ?[\[(] ?dot ?[\])] ?\w{2,})*"),
    "number": re.compile(r"[+(]{0,2}[0-9](?:[ ().\-/]{0,2}[0-9])+"),
    "secret": re.compile(r"[A-Za-z0-9_+/=\-]{16,}"),
}
# Formats of keys that are certain, and of words that are certainly none.
_CERTAIN_SECRET = re.compile(r"AKIA[A-Z0-9]{16}|[0-9a-f]{18,}|[A-Za-z_]{2,20}=[0-9a-f]{12,}|gh[pousr]_[A-Za-z0-9]{36}")
#: An address that base rules miss: its sign with what is around it, and the ending of its host.
_SIGN = re.compile(r"(?<=\S)( ?)(@|[\[(] ?at ?[\])])( ?)(?=\S)")
_ENDING = re.compile(r"(?:\.| ?[\[(] ?dot ?[\])] ?)[A-Za-z]{2,}\W*\Z")
_NAME_ENDS = re.compile(r"[\s@,;:<>\"]")
#: Forms in which addresses are hidden: the sign and the dots of the host.
_FORMS = ((" [at] ", " [dot] "), (" (at) ", " (dot) "), (" (at) ", "."), ("[at]", "[dot]"), (" @ ", "."))
_CONTEXT = re.compile(r"(?i)(mail)|(phone|tel|call|mobil)|(card|visa|credit)|(password|passwd|secret|token|key|auth)|(address|host|server)")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Addresses, leftmost and not overlapping: what ``[NAME]+`` before HOST finds, in linear time."""
    found, low = [], 0
    for m in HOST.finditer(text):
        # Names hold no sign, so none begins before the last one.
        low = max(low, text.rfind("@", low, m.start()) + 1)
        start = low + len(text[low : m.start()].rstrip(NAME))
        if start < m.start():
            found.append((start, m.end()))
        low = m.end() if start < m.start() else m.start() + 1
    return found


def _small(number: str) -> bool:
    """Whether digits, however many, are at most 255."""
    digits = number.lstrip("0")
    return len(digits) < 3 or (len(digits) == 3 and digits <= "255")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the rules, by kind as listed, then start, in time linear in the text."""
    found = [("email", *span) for span in _emails(text)] if "@" in text else []
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = re.sub("[ -]", "", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m.group())) <= 15]
    return found


def _proposed_emails(text: str) -> list[tuple[int, int]]:
    """Whole runs around a sign: what stands before it up to a border, its host and spelt-out dots."""
    found, low = [], 0
    for m in PROPOSED["email"].finditer(text):
        name = text[low : m.start()]
        border = max((name.rfind(c) for c in " \t\n\r@,;:<>\""), default=-1)
        odd = _NAME_ENDS.search(name, border + 1)  # white space beyond ASCII
        while odd:
            border = odd.start()
            odd = _NAME_ENDS.search(name, border + 1)
        if border + 1 < len(name):
            found.append((low + border + 1, m.end()))
        low = m.end()
    return found


def proposals(text: str) -> list[tuple[str, int, int]]:
    found = []
    if "@" in text or "at)" in text or "at]" in text or "at )" in text or "at ]" in text:
        found += [("email", *span) for span in _proposed_emails(text)]
    found += [("number", *m.span()) for m in PROPOSED["number"].finditer(text) if m.end() - m.start() >= 5]
    found += [("secret", *m.span()) for m in PROPOSED["secret"].finditer(text)]
    return found


def _hidden(s: str) -> tuple[str, bool] | None:
    """The sign of an address that hides, and whether there is as much space on both its sides."""
    sign, ending = _SIGN.search(s), _ENDING.search(s)
    if sign is None or ending is None or sign.end() >= ending.start():
        return None
    return sign[2], sign[1] == sign[3]


def hidden_emails(text: str) -> list[tuple[str, str, int, int]]:
    """(text, family, start, end): every base address with what is around it, rewritten in each of _FORMS."""
    out = []
    for start, end in _emails(text) if "@" in text else ():
        name, host = text[start:end].split("@")
        before, after = text[max(0, start - 24) : start], text[end : end + 1]
        for sign, dot in _FORMS:
            around = f"{before}{name}{sign}{host.replace('.', dot)}{after}"
            out += [(around, *x) for x in proposals(around) if x[0] == "email" and x[1] <= len(before) < x[2]]
    return out


def features(text: str, family: str, start: int, end: int) -> list[float]:
    s = text[start:end]
    n = len(s)
    before, after = text[max(0, start - 1) : start], text[end : end + 1]
    context = text[max(0, start - 24) : start]
    digits = sum(c.isdigit() for c in s)
    upper = sum(c.isupper() for c in s)
    letters = sum(c.isalpha() for c in s)
    only = "".join(c for c in s if c in "0123456789")
    counts = {c: s.count(c) for c in set(s)}
    entropy = -sum(v / n * math.log2(v / n) for v in counts.values())
    switches = sum(a.isdigit() != b.isdigit() for a, b in zip(s, s[1:]))
    words = {m.lastindex for m in _CONTEXT.finditer(context)}
    groups = [g for g in re.split(r"\D+", s) if g]
    return [
        ("email", "number", "secret").index(family),
        n, digits, digits / n, upper / max(letters, 1), letters / n, entropy, switches / n,
        s.count("."), s.count("-"), s.count(" "), s.count("("), float(s[:1] == "+"), s.count("@"), s.count("="),
        float(len(only) >= 13 and luhn(only)), max((int(g[:6]) for g in groups), default=0), len(groups),
        len(re.findall(r"[\[(] ?(?:at|dot) ?[\])]", s)), float(_hidden(s) is not None),
        float(before.isalnum()), float(after.isalnum()), float(before in "\"'=:"), float(not after or after.isspace()),
        *[float(i in words) for i in range(1, 6)],
    ]


def strict_label(text: str, family: str, start: int, end: int) -> int | None:
    """1: certainly personal or secret, 0: certainly not, None: the trees are to decide."""
    s = text[start:end].strip(" .-(")
    if family == "secret":
        return 1 if _CERTAIN_SECRET.fullmatch(s) else 0 if s.isalpha() or sum(c.isdigit() for c in s) < 2 else None
    if family == "email" and not _emails(s):
        # Without an ending of the host, or with a space on one side of the sign only (a mention), it is prose.
        hidden = _hidden(s)
        return None if hidden and (hidden[0] != "@" or hidden[1]) else 0
    spans = base_spans(text[start:end])
    if any(b - a >= 0.8 * len(s) for _, a, b in spans):
        return 1
    digits = sum(c.isdigit() for c in s)
    if 13 <= digits <= 19 and family == "number" and not luhn(re.sub(r"\D", "", s)):
        return 0
    return 0 if family == "email" or digits < 8 or IP.fullmatch(s) else None


class Trees:
    """Boosted regression trees for the logistic loss, over binned features."""

    def __init__(self):
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        bins = self._bins(x)
        rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.start = math.log(rate / (1 - rate))
        score = np.full(len(y), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(bins, y - p, p * (1 - p))
            self.trees.append(tree)
            score += self._walk(tree, bins)
        return self

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], axis=1)

    def _grow(self, bins, gradient, curve):
        size = 2 ** (DEPTH + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size, int), np.zeros(size)
        node = np.zeros(len(bins), int)
        for at in range(size):
            here = node == at
            if not here.any():
                continue
            g, h = gradient[here], curve[here]
            value[at] = RATE * g.sum() / (h.sum() + 1.0)
            if at >= size // 2:
                continue
            best = (1e-6, -1, 0)
            for f in range(bins.shape[1]):
                b = bins[here, f]
                gs, hs = np.cumsum(np.bincount(b, g, BINS)), np.cumsum(np.bincount(b, h, BINS))
                gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - gs[-1] ** 2 / (hs[-1] + 1)
                place = int(gain[:-1].argmax())
                if gain[place] > best[0]:
                    best = (gain[place], f, place)
            if best[1] >= 0:
                feature[at], cut[at] = best[1:]
                node[here] = 2 * at + 1 + (bins[here, best[1]] > best[2])
        return feature, cut, value

    def _walk(self, tree, bins):
        return tree[2][self._nodes(tree, bins)]

    @staticmethod
    def _nodes(tree, bins):
        feature, cut, _ = tree
        node = np.zeros(len(bins), int)
        for _ in range(DEPTH):
            f = feature[node]
            inner = f >= 0
            right = bins[np.arange(len(bins)), np.maximum(f, 0)] > cut[node]
            node = np.where(inner, 2 * node + 1 + right, node)
        return node

    def fit_frame(self, rows: DataFrame, width: int, x: str = "x", y: str = "label") -> Trees:
        """What ``fit`` does, over every row of ``rows``: Spark sums gradients by node, feature and bin.

        Edges are approximate quantiles; each level of each tree is one pass over the rows.
        """
        qs = np.linspace(0, 1, BINS + 1)[1:-1].tolist()
        got = rows.agg(F.avg(y).alias("rate"), *[F.percentile_approx(F.col(x)[i], qs, 10_000).alias(f"q{i}") for i in range(width)]).first()
        self.edges = [np.unique(np.array(got[f"q{i}"], float)) for i in range(width)]
        rate = min(max(got["rate"], 1e-3), 1 - 1e-3)
        self.start = math.log(rate / (1 - rate))
        size = 2 ** (DEPTH + 1) - 1
        for _ in range(TREES):
            tree = np.full(size, -1), np.zeros(size, int), np.zeros(size)
            for level in range(DEPTH + 1):
                low, count = 2**level - 1, 2**level
                g, h, n = _node_sums(rows, x, y, width, self, tree, low, count)
                for j in range(count):
                    at = low + j
                    if not n[j, 0].sum():
                        continue
                    tree[2][at] = RATE * g[j, 0].sum() / (h[j, 0].sum() + 1.0)
                    if at >= size // 2:
                        continue
                    best = (1e-6, -1, 0)
                    for f in range(width):
                        gs, hs = np.cumsum(g[j, f]), np.cumsum(h[j, f])
                        gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - gs[-1] ** 2 / (hs[-1] + 1)
                        place = int(gain[:-1].argmax())
                        if gain[place] > best[0]:
                            best = (gain[place], f, place)
                    if best[1] >= 0:
                        tree[0][at], tree[1][at] = best[1:]
            self.trees.append(tree)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        bins = self._bins(x)
        score = self.start + sum(self._walk(t, bins) for t in self.trees)
        return 1 / (1 + np.exp(-score))


def _values(batch: pa.RecordBatch, x: str, width: int) -> np.ndarray:
    return pc.list_flatten(batch.column(x)).to_numpy(zero_copy_only=False).reshape(-1, width)


def _node_sums(rows: DataFrame, x: str, y: str, width: int, model: Trees, tree, low: int, count: int):
    """Sums of gradient, curve and rows by node of ``tree`` from ``low`` on, feature and bin; the trees fitted so far give the scores."""
    edges, trees, start = model.edges, list(model.trees), model.start
    tree = tuple(a.copy() for a in tree)
    cells = count * width * BINS

    def sums(batches):
        done = Trees()
        done.edges, done.trees, done.start = edges, trees, start
        total = np.zeros((3, cells))
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = done._bins(_values(batch, x, width))
            score = start + sum((done._walk(t, bins) for t in trees), np.zeros(len(bins)))
            p = 1 / (1 + np.exp(-score))
            label = batch.column(y).to_numpy(zero_copy_only=False).astype(float)
            node = Trees._nodes(tree, bins) - low
            here = (node >= 0) & (node < count)
            at = ((node[here, None] * width + np.arange(width)) * BINS + bins[here]).ravel()
            for i, w in enumerate((label - p, p * (1 - p), np.ones(len(p)))):
                total[i] += np.bincount(at, np.repeat(w[here], width), cells)
        kept = np.flatnonzero(total[2])
        if len(kept):
            yield pa.record_batch([pa.array(kept, pa.int64()), *[pa.array(total[i, kept]) for i in range(3)]], names=["k", "g", "h", "n"])

    found = rows.select(x, y).mapInArrow(sums, "k long, g double, h double, n double").groupBy("k").agg(*[F.sum(c).alias(c) for c in "ghn"])
    out = np.zeros((3, cells))
    for r in found.collect():
        out[:, r.k] = r.g, r.h, r.n
    return tuple(out.reshape(3, count, width, BINS))


def fit_pii(docs: DataFrame, text: str = "text"):
    """(trees, threshold per family) from every distinct proposal with a strict label.

    A quarter of them, by hash, is kept apart for the thresholds; the trees learn from the rest.
    """
    width = len(features("1", "number", 0, 1))

    def labelled(batches):
        for part in slices(batches, text):
            rows, hashes, labels, seen = [], [], [], set()
            for whole in part.column(text).to_pylist():
                found = [(whole, *x, strict_label(whole, *x)) for x in proposals(whole)]
                for t, family, a, b, label in found + [(*x, 1) for x in hidden_emails(whole)]:
                    # Most proposals are long words: their rank decides before their features are computed.
                    if label is not None:
                        around = t[max(0, a - 24) : b + 1]
                        h = zlib.crc32(f"{family}{around}".encode("utf-8", "surrogatepass"))
                        if (h, label) in seen:
                            continue
                        seen.add((h, label))
                        hashes.append(h)
                        labels.append(label)
                        rows.append((t, family, a, b))
            yield pa.record_batch(
                [pa.array(hashes, pa.int64()), pa.array(labels, pa.int32()), pa.array([features(*r) for r in rows], pa.list_(pa.float64()))],
                names=["h", "label", "x"],
            )

    rows = docs.select(F.col(text).cast("string").alias(text)).where(F.length(text) > 0).mapInArrow(labelled, "h long, label int, x array<double>")
    # Distinct hashes first, so a span with many copies counts once; stored, so the texts are read once.
    rows = written(rows.groupBy("h", "label").agg(F.min("x").alias("x")))
    labels = {r.label for r in rows.groupBy("label").count().collect()}
    apart = F.col("h") % 4 == 0
    learn = rows.where(~apart)
    size = learn.count()
    if len(labels) < 2 or not size:
        return Trees().fit(np.zeros((1, width)), np.zeros(1)), [1.1] * 3
    # Each part gives sums over its rows: as many parts as the rows need, however the input was split.
    trees = Trees().fit_frame(learn.coalesce(-(-size // LEARN_PART)), width)
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def scored(batches):
        for batch in batches:
            x = _values(batch, "x", width)
            yield pa.record_batch([pa.array(x[:, 0].astype(np.int32)), pa.array(sent.value.predict(x)), batch.column("label")], names=["family", "p", "label"])

    # A threshold cannot part equal scores: they are taken together, highest first.
    by = rows.where(apart).select("x", "label").mapInArrow(scored, "family int, p double, label int")
    by = by.groupBy("family", "p").agg(F.count("*").alias("n"), F.sum("label").alias("good"))
    upto = Window.partitionBy("family").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by = by.select("family", "p", F.sum("n").over(upto).alias("n"), F.sum("good").over(upto).alias("good"))
    least = dict(by.where(F.col("good") >= PRECISION * F.col("n")).groupBy("family").agg(F.min("p")).collect())
    return trees, [max(0.9, least[i]) if i in least else 1.1 for i in range(3)]


def _kind(family: str, s: str) -> str:
    if family != "number":
        return family
    digits = sum(c.isdigit() for c in s)
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3}", s):
        return "ip"
    return "card" if digits >= 13 and s[0] not in "+(" else "phone"


class _Taken:
    """Disjoint stretches of a text, in order."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def outside(self, a: int, b: int) -> list[tuple[int, int]]:
        """The parts of a to b that are not taken."""
        parts, i = [], bisect_right(self.ends, a)
        while i < len(self.starts) and self.starts[i] < b:
            if a < self.starts[i]:
                parts.append((a, self.starts[i]))
            a = self.ends[i]
            i += 1
        return [*parts, (a, b)] if a < b else parts

    def add(self, a: int, b: int) -> None:
        i = bisect_right(self.starts, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


def all_spans(text: str, model) -> tuple[list, list]:
    """(base spans, all spans): what the trees add does not overlap a base span or one added before.

    A secret that does is added as the parts outside of these.
    """
    base = base_spans(text)
    taken = _Taken([(s, e) for _, s, e in base])
    proposed = [
        (family, a, b)
        for family, a, b in proposals(text)
        if (family == "secret" or taken.outside(a, b) == [(a, b)]) and strict_label(text, family, a, b) != 0
    ]
    added = []
    if proposed:
        trees, thresholds = model
        p = trees.predict(np.array([features(text, *x) for x in proposed]))
        for score, (family, a, b) in sorted(zip(p.tolist(), proposed), key=lambda t: (-t[0], t[1])):
            if score >= thresholds[("email", "number", "secret").index(family)]:
                free = taken.outside(a, b)
                # A long secret may hold digits that look like a card.
                for part in free if family == "secret" or free == [(a, b)] else ():
                    added.append((_kind(family, text[a:b]), *part))
                    taken.add(*part)
    order = {k: i for i, k in enumerate((*KINDS, *MORE_KINDS))}
    return base, sorted({*base, *added}, key=lambda s: (order[s[0]], s[1], s[2]))


def find_pii(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``docs`` with base and pii: arrays of (kind, start, end), in code points, ends exclusive.

    A null text counts as empty. Work is linear in a text's length, whatever it holds. Repeated rows get the
    same spans. All columns stay; those of the results' names are replaced. An empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("base", "pii")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def found(batches):
        for part in slices(batches, text):
            both = [all_spans(t or "", sent.value) for t in part.column(text).to_pylist()]
            columns = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x[i]] for x in both], kind) for i in (0, 1)]
            yield pa.record_batch([*part.columns, *columns], names=[*part.schema.names, "base", "pii"])

    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    return kept.mapInArrow(found, with_fields(kept.schema, f"base {spans}, pii {spans}"))


def redact(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``docs`` in whose texts every span found, overlapping ones as one, is replaced by [KIND].

    Null and empty texts stay as they are, repeated rows are changed alike, and so are all columns and the order
    of columns; very long texts take time in proportion.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def clean(t: str | None) -> str | None:
        if not t:
            return t
        out, last = [], 0
        for name, a, b in sorted(all_spans(t, sent.value)[1], key=lambda s: (s[1], -s[2])):
            if a >= last:
                out += [t[last:a], f"[{name.upper()}]"]
            last = max(last, b)
        return "".join([*out, t[last:]])

    def cleaned(batches):
        for part in slices(batches, text):
            column = pa.array([clean(t) for t in part.column(text).to_pylist()], pa.string())
            yield part.set_column(at, text, column)

    return docs.mapInArrow(cleaned, docs.schema)


def _joined(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_pii(spark, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of every document; a null text is empty, repeated rows give equal rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_pii(docs, fit_pii(docs))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("pii").alias("spans"))


def stage_pii(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data and secrets replaced in its text and n_chars of the result."""
    done = redact(docs, fit_pii(docs))
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done

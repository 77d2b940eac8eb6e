"""Personal data by boosted trees over candidate spans, beside fixed formats."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthlens.llm.boosting import BoostedTrees, fit_trees
from growthlens.llm.common import text_slices

# The kinds in their order, and the formats that always count.
KINDS = ("email", "ip", "card", "phone")
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
# A match of dotted numbers starts at the head of its first run of digits, or it fails in all of it.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]")

# High-recall generators: other ways to write the same data, right or wrong.
_SPELT_AT = re.compile(
    r"(?:\x20?[\[({<]\x20?(?:at|AT|@)\x20?[\])}>]\x20?|\x20(?:at|AT)\x20|\x20?[@＠]\x20?)"
    r"(?=([A-Za-z0-9-]{1,63}(?:(?:\x20?[\[({<]\x20?(?:dot|DOT|\.)\x20?[\])}>]\x20?|\x20(?:dot|DOT)\x20|\x20\.\x20|\.)[A-Za-z0-9-]{1,63}){1,6}))"
)
_SPELT_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_DEFANGED = re.compile(r"(?<![0-9])[0-9]{1,5}(?:(?:\x20?[\[({]\x20?(?:dot|\.)\x20?[\])}]\x20?|\x20\.\x20|\.)[0-9]{1,5}){3}(?![0-9])")
_GROUPED = re.compile(r"(?<![0-9])[0-9](?:[\x20./_\xa0-]{0,2}[0-9]){12,18}(?![0-9])")
_NATIONAL = re.compile(r"(?<![0-9])(?:\+|00)?\(?[0-9]{1,5}\)?(?:[\x20./\xa0-]{1,2}\(?[0-9]{2,5}\)?){1,4}(?![0-9])")
_WORDS = (
    re.compile(r"(?:e-?mail|mailto|contact|write|kontakt|correo|courriel)", re.I),
    re.compile(r"(?:\bip\b|address|host|server|ping|ssh)", re.I),
    re.compile(r"(?:card|visa|master|credit|amex|karte|tarjeta|carte)", re.I),
    re.compile(r"(?:phone|call|tel\b|tel\.|mobile|fax|whatsapp|tel[eé]f)", re.I),
    re.compile(r"(?:version|\bv$|isbn|order|invoice|\bno\.?\s*$|#\s*$|page|section|fig|http|www|\bid\b|=\s*$)", re.I),
)
CONTEXT = 24
# Longer spans are no examples.
LONGEST = 200
# Base spans of a kind that learning takes at most, and as many of its other candidates, drawn in so many parts.
SAMPLE_SPANS = 2048
SAMPLE_PARTS = 64
# Fewer examples of a kind than this, and the kind gets no spans beside its base ones.
LEAST_EXAMPLES = 40
# Precision that a kind's threshold must keep on the examples held out.
PRECISION = 0.99

Span = tuple[int, int, int]  # start, end, place of the kind


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for match in _AT.finditer(text):
        at = match.start()
        low = max(done, text.rfind("@", done, at) + 1)
        start = at - len(_LOCAL.match(text[low:at][::-1]).group())  # the part in front, read backwards
        if start < at:
            yield start, match.end()
            done = match.end()


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """(start, end) of the fixed formats by kind, each leftmost and non-overlapping; failing matches are dropped.

    Every pattern reads a text in linear time, whatever it holds.
    """
    found: list[list[tuple[int, int]]] = [[], [], [], []]
    if "@" in text:
        found[0] = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m.group().split("."))):
            found[1].append(m.span())
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start():
            digits = _DIGITS.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found[2].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.sub("", m.group())) <= 15:
                found[3].append(m.span())
    return found


def candidates(text: str) -> list[Span]:
    """Spans that may be personal data in any spelling; they overlap freely."""
    out: list[Span] = []
    if "@" in text or "＠" in text or " at " in text or "at" in text.lower() and ("[" in text or "(" in text or "{" in text):
        for m in _SPELT_AT.finditer(text):
            local = _SPELT_LOCAL.search(text[max(0, m.start() - 64) : m.start()])
            if local:
                out.append((m.start() - len(local.group()), m.end(1), 0))
    for kind, pattern in ((1, _DEFANGED), (2, _GROUPED), (3, _NATIONAL)):
        out += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if kind < 3 or 7 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate as numbers."""
    start, end, kind = span
    body = text[start:end]
    digits = _DIGITS.sub("", body)
    groups = [len(g) for g in re.split(r"[^0-9]+", body) if g]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    words = [w for w in re.split(r"[^A-Za-z0-9%+-]+", body) if w]
    last = words[-1] if words else ""
    parts = [int(g) for g in re.findall(r"[0-9]{1,9}", body)][:4]
    return [
        len(body), len(digits), len(digits) / len(body), len(groups), max(groups, default=0), min(groups, default=0),
        groups[0] if groups else 0, groups[-1] if groups else 0, len(set(digits)), float(bool(digits) and luhn(digits)),
        int(digits[0]) if digits else -1, max(parts, default=-1), parts[0] if parts else -1, sum(x > 255 for x in parts),
        body.count("."), body.count("-"), body.count(" "), body.count("/"), sum(body.count(c) for c in "[](){}<>"),
        float("@" in body), float("dot" in body.lower()), float(" at " in body.lower()), float(body[:1] == "+"), float(body[:2] == "00"),
        len(last), float(last.isalpha()), float(last[:1].isupper()), len(words[0]) if words else 0, len(words), float("\n" in body),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "./-_=#"), float(after[:1] in "/-_%="),
        sum(c.isdigit() for c in before[-10:]), sum(c.isdigit() for c in after[:10]),
        *[float(bool(w.search(before))) for w in _WORDS], float(bool(_WORDS[kind].search(before + after))),
    ]


def respelt(body: str, kind: int, r: np.random.Generator) -> str:
    """One other spelling of a value of a base format."""
    digits = _DIGITS.sub("", body)
    if kind == 0:
        local, _, domain = body.partition("@")
        at = ("@", " @ ", " at ", " [at] ", "[at]", " (at) ", "(at)", " AT ")[r.integers(8)]
        dot = (".", " dot ", " [dot] ", "[dot]", "(dot)", " DOT ", "[.]")[r.integers(1 if at in ("@", " @ ") and r.random() < 0.5 else 7)]
        return local + at + domain.replace(".", dot)
    if kind == 1:
        return body.replace(".", ("[.]", "(.)", " . ", "[dot]", " [.] ")[r.integers(5)])
    if kind == 2:
        sep = (".", "/", "_", "  ", "\xa0")[r.integers(5)]
        return sep.join(digits[k : k + 4] for k in range(0, len(digits), 4))
    national = digits[-10:] if len(digits) > 10 else digits
    cut = max(2, len(national) - 7)
    a, b, c = national[:cut], national[cut : cut + 3], national[cut + 3 :]
    sep = ("-", ".", " ", "/", "\xa0")[r.integers(5)]
    return (f"({a}) {b}{sep}{c}", f"{a}{sep}{b}{sep}{c}", f"00{digits[:-10] or 1} {a}{sep}{b}{sep}{c}", f"({a}){sep}{b}{sep}{c}")[r.integers(4)]


def spoilt(body: str, kind: int, r: np.random.Generator) -> str:
    """A look-alike of a value that is no personal data: wrong check digit, parts out of range, dates and numbers."""
    digits = _DIGITS.sub("", body)
    if kind == 0:
        return ("look at it.Then", "meet at 5.30", "price @ 3.50", "ends at v2.0", "talk at home.So", "stay at gate . We", "best @ all.And")[r.integers(7)]
    if kind == 1:
        parts = [str(r.integers(0, 999)) for _ in range(4)]
        parts[r.integers(4)] = str(r.integers(256, 99999))
        return (".", "[.]", "(.)", " . ")[r.integers(4)].join(parts)
    if kind == 2:
        wrong = str((int(digits[-1]) + r.integers(1, 10)) % 10)
        while luhn(digits[:-1] + wrong):
            wrong = str((int(wrong) + 1) % 10)
        digits = digits[:-1] + wrong
        sep = (".", "/", "_", " ", "-", "")[r.integers(6)]
        return sep.join(digits[k : k + 4] for k in range(0, len(digits), 4))
    a, b, c, d = r.integers(1900, 2100), r.integers(1, 13), r.integers(1, 29), r.integers(0, 60)
    return (
        f"{a}-{b:02d}-{c:02d}", f"{a}/{b:02d}/{c:02d} {b:02d}", f"{c:02d}.{b:02d}.{a}", f"{a}-{a + 3} {c}", f"{d} {a} {c:02d} {b:02d}",
        f"{c}.{d:02d} {a}.{b:02d}", f"{a * 7} {d:02d} {b:02d}", f"{d}/{c} {a}", f"{c:02d} {b:02d} {d:02d} {c:02d}",
    )[r.integers(9)]


@dataclass
class SpanModel:
    """Boosted trees and thresholds of the kinds that were learnt."""

    trees: dict[int, BoostedTrees] = field(default_factory=dict)
    thresholds: dict[int, float] = field(default_factory=dict)

    def added(self, texts: list[str], bases: list[list[list[tuple[int, int]]]]) -> list[list[Span]]:
        """By text, the candidates clear of its base spans that reach their kind's threshold; of overlapping ones the likelier."""
        free: dict[int, list[tuple[int, Span]]] = {k: [] for k in self.trees}
        for i, (text, base) in enumerate(zip(texts, bases, strict=True) if free else ()):
            taken = sorted(s for spans in base for s in spans)
            ends = list(accumulate((e for _, e in taken), max))
            for span in candidates(text):
                at = bisect_right(ends, span[0])
                if span[2] in free and (at == len(taken) or taken[at][0] >= span[1]):
                    free[span[2]].append((i, span))
        scored: list[list[tuple[float, Span]]] = [[] for _ in texts]
        for kind, spans in free.items():
            if spans:
                for (i, span), p in zip(spans, self.trees[kind].probability(np.array([features(texts[i], s) for i, s in spans])), strict=True):
                    if p >= self.thresholds[kind]:
                        scored[i].append((-float(p), span))
        out: list[list[Span]] = [[] for _ in texts]
        for kept, found in zip(out, scored, strict=True):
            places: list[tuple[int, int]] = []  # disjoint, by start
            for _, span in sorted(found):
                at = bisect_right(places, (span[0], span[1]))
                if (at == 0 or places[at - 1][1] <= span[0]) and (at == len(places) or span[1] <= places[at][0]):
                    places.insert(at, span[:2])
                    kept.append(span)
        return out


def _windows(docs: DataFrame, sample: int, seed: int) -> DataFrame:
    """Distinct base spans and other candidates of ``docs`` (kind, base, before, body, after), ``sample`` of each kind and sort.

    They are drawn by hash, as many from each of SAMPLE_PARTS parts, so no task
    meets a kind's spans of the whole corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches):
            out = []
            for text in texts:
                base = base_spans(text)
                spans = [(s, e, k, True) for k, found in enumerate(base) for s, e in found]
                taken = sorted(s for found in base for s in found)
                ends = list(accumulate((e for _, e in taken), max))
                for s, e, k in candidates(text):
                    at = bisect_right(ends, s)
                    if at == len(taken) or taken[at][0] >= e:
                        spans.append((s, e, k, False))
                for s, e, k, is_base in spans:
                    if e - s <= LONGEST:
                        out.append((k, is_base, text[max(0, s - 2 * CONTEXT) : s], text[s:e], text[e : e + 2 * CONTEXT]))
            if out:
                names = ["kind", "base", "before", "body", "after"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)

    found = docs.select("text").mapInArrow(run, "kind long, base boolean, before string, body string, after string").distinct()
    drawn = found.withColumn("draw", F.xxhash64(F.lit(seed), "kind", "before", "body", "after"))
    parts = Window.partitionBy("kind", "base", F.pmod("draw", F.lit(SAMPLE_PARTS))).orderBy("draw", "before", "body", "after")
    return drawn.withColumn("place", F.row_number().over(parts)).where(F.col("place") <= max(1, sample // SAMPLE_PARTS))


def _examples(rows: list, kind: int, r: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the candidates that the generators find where ``rows`` (before, body, after, label) put a value."""
    x, y = [], []
    for before, body, after, label in rows:
        text, at = before + body + after, len(before)
        for span in candidates(text):
            if span[2] == kind and span[0] < at + len(body) and at < span[1]:
                whole = abs(span[0] - at) <= 1 and abs(span[1] - at - len(body)) <= 1
                x.append(features(text, span))
                y.append(int(label and whole))
    return np.array(x), np.array(y)


def fit_span_model(docs: DataFrame, sample: int = SAMPLE_SPANS, seed: int = 11) -> SpanModel:
    """Learns the kinds from ``docs`` without labels; ``sample`` bounds the spans of each kind and sort on the driver.

    Base spans in their places, written in other ways or beside one another, are
    examples of personal data, look-alikes in the same places of none.  The texts' other candidates
    join the latter if trees of these examples alone find them unlikely.  Spans
    are drawn by hash and taken in a total order, so reruns learn the same.  A
    fifth of the examples is held out: it calibrates the scores and sets each
    kind's threshold at the lowest score that keeps PRECISION; a kind without
    enough examples, or that nowhere keeps it, gets no spans beside its base.
    """
    rows = _windows(docs, sample, seed).select("kind", "base", "draw", "before", "body", "after").collect()
    rows.sort(key=lambda row: (row["draw"], row["before"], row["body"], row["after"]))
    model = SpanModel()
    bases = [row["body"] for row in rows if row["base"]]
    for kind in range(len(KINDS)):
        r = np.random.default_rng([seed, kind])
        put = []
        for row in rows:
            if row["kind"] == kind and row["base"]:
                for body, label in ((respelt(row["body"], kind, r), 1), (respelt(row["body"], kind, r), 1), (spoilt(row["body"], kind, r), 0)):
                    put.append((row["before"], body, row["after"], label))
                # values in a row, which the fixed formats run together
                other = bases[r.integers(len(bases))]
                put.append((row["before"], row["body"], " " + other + row["after"], 1))
                put.append((row["before"] + other + " ", row["body"], row["after"], 1))
        x, y = _examples(put, kind, r)
        if not len(y) or min(y.sum(), (1 - y).sum()) < LEAST_EXAMPLES:
            continue
        others = [(row["before"], row["body"], row["after"], 0) for row in rows if row["kind"] == kind and not row["base"]]
        more, none = _examples(others, kind, r)
        if len(none):
            unlikely = fit_trees(x, y).probability(more) < 0.5
            x, y = np.concatenate([x, more[unlikely]]), np.concatenate([y, none[unlikely]])
        held = r.random(len(x)) < 0.2
        trees = fit_trees(x[~held], y[~held]).calibrated(x[held], y[held])
        score = trees.probability(x[held])
        order = np.argsort(-score, kind="stable")
        precision = np.cumsum(y[held][order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(precision >= PRECISION)
        if len(good):
            model.trees[kind] = trees
            model.thresholds[kind] = max(0.5, float(score[order][good[-1]]))
    return model


def find_personal_data(docs: DataFrame, model: SpanModel) -> DataFrame:
    """doc_id, base and found spans of every row of ``docs``; a map without shuffles.

    ``base`` lists the fixed formats and ``spans`` those and the model's, as
    array<struct<kind, start, end>> by kind, then start (code points, end
    exclusive).  Null and empty texts have none; null ids are kept; repeated
    rows are judged each; an empty table gives no rows; other columns are not
    read.  A text's spans depend on it and the model alone.
    """
    struct = "array<struct<kind: string, start: int, end: int>>"
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, base {struct}, spans {struct}"
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def listed(spans: list[Span]) -> list[dict]:
        return [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in sorted((k, s, e) for s, e, k in spans)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            found = [base_spans(text) for text in texts]
            mine = [[(s, e, k) for k, spans in enumerate(x) for s, e in spans] for x in found]
            base = [listed(x) for x in mine]
            every = [listed(x + more) for x, more in zip(mine, held.value.added(texts, found), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(base, kind_type), pa.array(every, kind_type)], names=["doc_id", "base", "spans"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every stretch that spans cover replaced by the kind of its first span in brackets."""
    done = F.aggregate(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.when(
                s["start"] >= acc["at"],
                F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]")),
            )
            .otherwise(acc["out"])
            .alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)

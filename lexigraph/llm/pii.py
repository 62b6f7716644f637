"""Personal data: fixed forms, and forms that their contexts give away.

Mentions of four kinds are found by fixed patterns (the base). The words around them make lexical
patterns of graded generality: the two words before a mention, the word before with the word after,
and the name of a field (``name:`` or ``name =``) that a mention is the value of. Other tokens
that look like identifiers (with a digit or an at sign) and stand in the same contexts are
candidates, but for those that have the form of a kind and fail its test, such as a card number with a
wrong check digit: they are known not to be any. Patterns and instances form a graph on which Spark passes confidence to and fro: a
pattern's is the mean of its instances', an unseen instance's the noisy-or of its patterns'. Patterns
that end with high confidence and enough different seeds mark their candidates as personal data.

Only mentions and candidates leave the scan of the texts; the graph is joined and grouped by Spark.

Defined cases: a NULL text is empty. Rows that repeat a doc_id, or have none, are judged by their
own texts. A candidate that overlaps a base mention is none. Of several kinds that patterns claim for a
candidate, the most confident wins, in the order of KINDS among equals.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lexigraph.llm.common import text_key, written

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_CONFIDENCE = 0.8
MIN_SEEDS = 5
#: Instances that a pattern is taken to have besides its own, none of them personal.
DOUBT = 0.5
MIN_CHARS = 5

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARKER = re.compile(r"[0-9@]")
_EDGE = "\"'`.,;:!?()[]{}<>|*&%$#="
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_NEXT = re.compile(rf"[^\x20\x09-\x0D{re.escape(_EDGE)}][^\x20\x09-\x0D]*+")
_QUOTES_AND_BLANKS = frozenset("\"'` \t\n\v\f\r([{<")
LONGEST_KEY = 64
_FOUND = (
    "doc_id bigint, key bigint, base string, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    "spans array<struct<kind: string, start: int, end: int, instance: string, contexts: array<string>>>"
)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; places are code points, the end is exclusive."""
    out = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        # the length bound comes first: a match can be as long as the text
        if len(m[0]) <= 37 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def _joined(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def _token(text: str, at: int) -> tuple[int, int]:
    """The token around a place, without blanks."""
    start = at
    while start and not _BLANK.match(text, start - 1):
        start -= 1
    end = _BLANK.search(text, at)
    return start, end.start() if end else len(text)


def _candidates(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    taken = sorted((a, b) for _, a, b in base)
    done = i = 0
    while m := _MARKER.search(text, done):
        start, end = _token(text, m.start())
        done = end
        left, right = start, end
        while left < right and text[left] in _EDGE:
            left += 1
        while right > left and text[right - 1] in _EDGE:
            right -= 1
        while i < len(taken) and taken[i][1] <= left:
            i += 1
        free = i == len(taken) or taken[i][0] >= right
        if free and right - left >= MIN_CHARS and _MARKER.search(text, left, right):
            if not _has_known_form(text[left:right]):
                yield left, right


def _word_before(text: str, at: int) -> tuple[str, int]:
    end = at
    while end and _BLANK.match(text, end - 1):
        end -= 1
    start = end
    while start and not _BLANK.match(text, start - 1):
        start -= 1
    return text[start:end].strip(_EDGE).lower(), start


def _field(text: str, start: int) -> str:
    """The name of the field whose value starts here, with its mark, or nothing."""
    at = start
    while at and text[at - 1] in _QUOTES_AND_BLANKS:
        at -= 1
    if not at or text[at - 1] not in ":=":
        return ""
    name, _ = _word_before(text, at - 1)
    return f"{_key(name)}{text[at - 1]}" if name else ""


def _key(word: str) -> str:
    """A word, or the digest of a long one, so that unlike words stay unlike."""
    return word if len(word) <= LONGEST_KEY else hashlib.sha256(word.encode("utf-8", "surrogatepass")).hexdigest()


def _contexts(text: str, start: int, end: int) -> list[str]:
    one, at = _word_before(text, start)
    two, _ = _word_before(text, at)
    rest = _NEXT.search(text, end)
    after = rest[0].strip(_EDGE).lower() if rest else ""
    field = _field(text, start)
    found = []
    if one and two:
        found.append(f"{_key(two)} {_key(one)} _")
    if one and after:
        found.append(f"{_key(one)} _ {_key(after)}")
    if field:
        found.append(f"{field} _")
    return found


def _has_known_form(text: str) -> bool:
    """A whole token with the form of an ip, card or phone: no candidate, as the base has judged it."""
    digits = len(_digits(text))
    return bool(
        _IP.fullmatch(text) or (16 <= digits <= 19 and _CARD.fullmatch(text)) or (8 <= digits <= 15 and _PHONE.fullmatch(text))
    )


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, key, text in zip(batch["doc_id"], batch["key"], batch["text"]):
            base = base_spans(text) if text else []
            spans = [(k, a, b) for k, a, b in base]
            spans += [(None, a, b) for a, b in _candidates(text, base)] if text else []
            counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
            rows.append((
                None if pd.isna(doc_id) else int(doc_id), key, _joined(base), *counts,
                [{"kind": k, "start": a, "end": b, "instance": text[a:b], "contexts": _contexts(text, a, b)}
                 for k, a, b in spans],
            ))
        columns = ["doc_id", "key", "base", *(f"n_{k}" for k in KINDS), "spans"]
        out = pd.DataFrame(rows, columns=columns)
        yield out.astype({"doc_id": "Int64"})


def trusted_patterns(mentions: DataFrame) -> DataFrame:
    """``context, kind, confidence`` from ``kind, instance, contexts``; kind is NULL for candidates."""
    edges = written(
        mentions.select("kind", F.xxhash64("instance").alias("instance"), F.explode("contexts").alias("context"))
        .groupBy("context", "instance").agg(F.max("kind").alias("kind")),
        "pattern-edges",
    )
    sizes = written(
        edges.groupBy("context").agg(F.count(F.lit(1)).alias("n"), F.count("kind").alias("seeds"))
        .where(F.col("seeds") > 0),
        "pattern-sizes",
    )
    seeds = edges.where(F.col("kind").isNotNull()).select("instance", "kind").distinct()
    scores = written(seeds.withColumn("score", F.lit(1.0)), "instance-scores-0")
    unseen = written(edges.where(F.col("kind").isNull()).select("context", "instance"), "unseen-edges")
    links = edges.select("context", "instance")
    for turn in range(1, ROUNDS + 1):
        mass = links.join(scores, "instance").groupBy("context", "kind").agg(F.sum("score").alias("mass"))
        trusted = written(
            mass.join(sizes, "context").select(
                "context", "kind", "seeds", (F.col("mass") / (F.col("n") + DOUBT)).alias("confidence")
            ),
            f"patterns-{turn}",
        )
        if turn < ROUNDS:
            doubt = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999999))))
            heard = (
                unseen.join(trusted.where(F.col("seeds") >= MIN_SEEDS), "context")
                .groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score"))
            )
            scores = written(seeds.withColumn("score", F.lit(1.0)).unionByName(heard), f"instance-scores-{turn}")
    return trusted.where((F.col("confidence") >= MIN_CONFIDENCE) & (F.col("seeds") >= MIN_SEEDS))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_<kind> of the base, base, added (array of spans) and spans: a row per document."""
    texts = docs.select(F.col("doc_id").cast("bigint"), text_key(F.col("text")).alias("key"), "text")
    found = written(texts.mapInPandas(_extract, _FOUND), "mentions")
    mentions = found.select("doc_id", "key", F.explode("spans").alias("m")).select("doc_id", "key", "m.*")
    trusted = written(trusted_patterns(mentions).select("context", "kind", "confidence"), "trusted")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    claims = (
        mentions.where(F.col("kind").isNull()).drop("kind")
        .select("doc_id", "key", "start", "end", F.explode("contexts").alias("context"))
        .join(trusted, "context")
        .groupBy("doc_id", "key", "start", "end")
        .agg(F.max_by("kind", F.struct("confidence", -rank)).alias("kind"))
        .groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    )
    on = found["doc_id"].eqNullSafe(F.col("_id")) & found["key"].eqNullSafe(F.col("_key"))
    none = F.array().cast("array<struct<kind: string, start: int, end: int>>")
    rows = found.join(written(claims, "claims"), on, "left").withColumn("added", F.coalesce("added", none))
    every = F.concat(
        F.transform(
            F.filter("spans", lambda s: s.kind.isNotNull()),
            lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")),
        ),
        F.col("added"),
    )
    order = F.array(*map(F.lit, KINDS))
    listed = F.array_sort(F.transform(
        every, lambda s: F.struct(F.array_position(order, s.kind).alias("k"), s.start.alias("a"), s.end.alias("e"))
    ))
    spelled = F.array_join(F.transform(
        listed,
        lambda s: F.concat_ws(":", F.element_at(order, s.k.cast("int")), s.a.cast("string"), s.e.cast("string")),
    ), ",")
    return rows.select("doc_id", *(f"n_{k}" for k in KINDS), "base", "added", spelled.alias("spans"))

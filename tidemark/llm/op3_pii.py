"""Personal data, and the terms that give it away.

Patterns find the protected entities (e-mail, IP, card and phone numbers).
The corpus then tells which neighbouring terms reveal them: with n_t
documents that hold a term, n_e that hold an entity, n_te where the term
stands within ``WINDOW`` words of it, and N documents in all,

    disclosure = PMI(term; entity) / IC(entity)
               = log(N n_te / (n_t n_e)) / log(N / n_e),

which is 1 when the term occurs with the entity only.  A term is disclosing
from ``DISCLOSED`` on if it was seen beside the entity in ``SUPPORT``
different contexts at least (copies of one passage are one context).
Disclosing terms become spans of kind ``term`` and are generalised (numbers,
names) or removed (other words) by ``sanitise``.

One pass over the texts gives the spans, the entities' contexts and the
document frequency of every word, counted in each task before the shuffle;
all statistics cover all documents.

Defined results: null text is empty, without spans; a context does not reach
over ``REACH`` characters to either side; terms inside a base span are never
spans of their own; repeated rows are counted and reported one by one; a null
id is reported as null; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import c, materialize, pieces_of, text_of

KINDS = ("email", "ip", "card", "phone", "term")
WINDOW, REACH = 10, 400
DISCLOSED, SUPPORT = 0.8, 2
#: words a task counts before it passes the counts on
COUNTED = 300_000
#: what stands in the place of a span
GENERAL = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++").match
_DIGIT = re.compile(r"[0-9]").search
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}").finditer
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++").finditer
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
_WORD = re.compile(r"[^\W_]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, found from each ``@`` outwards in linear time."""
    last, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN(text, at + 1)
        start = at
        while m and start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            yield start, m.end()
            last = m.end()
            at = text.find("@", last)
        else:
            at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of every base entity, by start, then kind as listed."""
    out = [(a, "email", b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT(text):
        for m in _IP(text):
            if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in m[0].split(".")):
                out.append((m.start(), "ip", m.end()))
        for m in _CARD(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), "card", m.end()))
        if "+" in text:
            for m in _PHONE(text):
                if 9 <= sum("0" <= ch <= "9" for ch in m[0]) <= 15:
                    out.append((m.start(), "phone", m.end()))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


def entity_of(kind: str, text: str) -> str:
    """The protected value that a span's text stands for."""
    if kind in ("card", "phone"):
        text = "".join(ch for ch in text if "0" <= ch <= "9")
    return f"{kind}:{text.lower()}"


def contexts(text: str, spans: list[tuple[int, str, int]]) -> Iterator[tuple[str, str, int, int, int]]:
    """(entity, term, start, end, context) of the words near each base span."""
    taken = [(a, b) for a, _, b in spans]
    for a, kind, b in spans:
        lo, hi = max(0, a - REACH), min(len(text), b + REACH)
        left = [m for m in _WORD.finditer(text, lo, a) if m.start() > lo or lo == 0][-WINDOW:]
        right = [m for m in _WORD.finditer(text, b, hi) if m.end() < hi or hi == len(text)][:WINDOW]
        near = [(m[0].lower(), m.start(), m.end()) for m in left + right]
        key = hashlib.blake2b(" ".join(w for w, _, _ in near).encode(), digest_size=8).digest()
        context = int.from_bytes(key, "big", signed=True)
        for w, x, y in near:
            if not any(x < q and p < y for p, q in _around(taken, x, y)):
                yield entity_of(kind, text[a:b]), w, x, y, context


def _around(taken: list[tuple[int, int]], x: int, y: int) -> Iterable[tuple[int, int]]:
    """Spans that may meet (x, y); they are sorted by start and few are near."""
    k = bisect_left(taken, (y,))
    return taken[max(0, k - 4 * len(KINDS)):k]


SCAN = ("doc_id long, uid long, base array<struct<start:int,kind:string,end:int>>, "
        "near array<struct<entity:string,term:string,start:int,end:int,context:long>>, term string, n long")


def _scan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = [x.split()[0] for x in re.sub(r"<.*?>+", "", SCAN).split(", ")]
    counted: Counter[str] = Counter()

    def counts() -> pd.DataFrame:
        rows = pd.DataFrame({x: None for x in cols}, index=range(len(counted)), dtype=object)
        rows["term"], rows["n"] = list(counted.keys()), list(counted.values())
        counted.clear()
        return rows
    for pdf in pieces_of(batches, "text", 4 << 20):
        rows = []
        for doc_id, uid, text in zip(pdf["doc_id"], pdf["uid"], pdf["text"]):
            spans = base_spans(text)
            near = [dict(zip(("entity", "term", "start", "end", "context"), x)) for x in contexts(text, spans)]
            rows.append((None if pd.isna(doc_id) else int(doc_id), uid,
                         [{"start": a, "kind": k, "end": b} for a, k, b in spans], near, None, None))
            counted.update(set(_WORD.findall(text.lower())))
        yield pd.DataFrame(rows, columns=cols, dtype=object)
        if len(counted) > COUNTED:
            yield counts()
    if counted:
        yield counts()


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         disclosed: float = DISCLOSED, support: int = SUPPORT, row_col: str | None = None) -> DataFrame:
    """``(doc_id, uid, spans array<struct<start, kind, end>>)`` of every row:
    base spans and disclosing terms, by start, then kind as listed.  ``uid``
    tells the rows apart; it is ``row_col`` (a stored, unique long) if given."""
    row = c(row_col) if row_col else F.monotonically_increasing_id()
    scan = materialize(
        docs.select(c(id_col).cast("long").alias("doc_id"), row.alias("uid"),
                    text_of(text_col).alias("text")).mapInPandas(_scan, SCAN), "pii_scan")
    rows = scan.where("uid IS NOT NULL")
    total = rows.count()
    near = rows.where(F.size("near") > 0).select("uid", F.explode("near").alias("x")).select("uid", "x.*")
    # documents and contexts of each pair, each distinct by itself, pre-aggregated
    def distinct(what: str, name: str) -> DataFrame:
        return near.select("entity", "term", what).distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias(name))
    joint = distinct("uid", "n_te").join(distinct("context", "contexts").where(F.col("contexts") >= support), ["entity", "term"])
    of_entity = (rows.where(F.size("near") > 0).select(F.explode(F.array_distinct(F.transform("near", lambda x: x["entity"]))).alias("entity"))
                 .groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")))
    of_term = scan.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n_t"))
    pmi = F.log(F.lit(float(max(total, 1))) * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    content = F.log(F.lit(float(max(total, 1))) / F.col("n_e"))
    telling = materialize(joint.join(of_entity, "entity").join(of_term, "term")
                          .where((content > 0) & (pmi >= disclosed * content)).select("entity", "term"), "pii_terms")
    terms = (near.join(telling, ["entity", "term"]).groupBy("uid")
             .agg(F.collect_set(F.struct("start", F.lit("term").alias("kind"), "end")).alias("terms")))
    rank = F.create_map(*(x for k, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(k))))
    every = F.array_union("base", F.coalesce("terms", F.array().cast("array<struct<start:int,kind:string,end:int>>")))
    ordered = F.transform(F.array_sort(F.transform(every, lambda s: F.struct(
        s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return rows.select("doc_id", "uid", "base").join(terms, "uid", "left").select("doc_id", "uid", ordered.alias("spans"))


def digest_columns(found: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)``."""
    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select(
        "doc_id", *map(count, KINDS[:4]),
        F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def replace(text: str, spans: Iterable) -> str:
    """The text with every span generalised or removed; what overlaps becomes one."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["end"] <= at:
            continue
        start = max(at, s["start"])
        out.append(text[at:start])
        if s["start"] >= at:
            word = text[s["start"]:s["end"]]
            out.append(GENERAL.get(s["kind"]) or ("[NUMBER]" if word.isdigit() else "[NAME]" if word[:1].isupper() else ""))
        at = s["end"]
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             disclosed: float = DISCLOSED, support: int = SUPPORT) -> DataFrame:
    """The rows of ``docs``, all columns as they are, with the spans of ``find``
    taken out of the texts (null stays null).

    The rows are written with an id of their own first, so ids that repeat or
    are null do not matter.
    """
    own = "row"
    while own in docs.columns:
        own += "_"
    # plain names on the way: a column's name may hold dots
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = materialize(docs.toDF(*names).withColumn(own, F.monotonically_increasing_id()), "pii_rows")
    text = names[docs.columns.index(text_col)]
    found = find(rows, names[docs.columns.index(id_col)], text, disclosed, support, own)
    spans = found.where(F.size("spans") > 0).select(F.col("uid").alias(own), F.col("spans").alias("spans_"))
    met = rows.join(spans, own, "left").drop(own)

    clean = F.pandas_udf(lambda t, s: pd.Series([x if y is None else replace(x, y) for x, y in zip(t, s)], dtype=object), "string")
    return met.withColumn(text, F.when(F.col("spans_").isNull(), F.col(text)).otherwise(clean(F.col(text), F.col("spans_")))
                          ).select(*names).toDF(*docs.columns)

"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs them.

Regexes find candidates, a gazetteer and the words before a span vote on them. EM estimates from the vote counts how
often each labeler is right, and the resulting probabilities train a naive Bayes classifier of spans on their shape
and context. It decides about the candidates that are no base match; base matches stay whatever it says. All of it
is DataFrame functions; what comes to the driver are counts by vote pattern and by feature, bounded by their number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.sources.shared import pinned

# The base kinds in the order in which spans are listed. The patterns find what the plain ones in the comments find,
# written so that Java neither recurses nor starts again inside a run it has just refused.
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ with 16 digits or more
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Numbers in groups that no base kind covers: national phone, insurance and account numbers.
MORE = {"number": r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{2,4}[\x20.-][0-9]{2,5}(?![0-9A-Za-z])"}
KINDS = [*BASE, *MORE]
_NEEDS = {"email": "@", "phone": "+"}      # a character without which a text needn't be searched
_BEFORE = 40                               # characters of context

# Gazetteers: common endings of host names, card issuers' first digits, calling codes of countries.
ENDINGS = ["com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info", "co", "it", "nl", "ch", "at"]
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|62|35)"
CALLING = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
PERSONAL = r"(?i)\b(mail|e-mail|contact|write|phone|tel|call|fax|mobile|card|visa|account|ssn|ip|host|client|login|" \
           r"kontakt|telefon|karte|teléfono|tarjeta|correo|téléphone|carte|courriel)\b"
IMPERSONAL = r"(?i)\b(version|v|release|section|chapter|page|isbn|order|figure|table|rfc|no)\.?\s*[:#]?\s*$"
LABELERS = ["shape", "gazetteer", "context", "counter"]


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once: a lambda's variable isn't copied into its uses."""
    return F.transform(F.array(value), body)[0]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(at: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - at, F.lit(1)).cast("int")
        double = digit * 2
        return F.when(at % 2 == 0, digit).when(double > 9, double - 9).otherwise(double)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda sum_, at: sum_ + value(at))
    return total % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    """What a match must have besides its pattern."""
    if kind == "ip":
        return F.forall(F.split(text, "\\."), lambda part: _let(
            F.regexp_replace(part, "^0+(?=[0-9])", ""),
            lambda p: (F.length(p) <= 3) & (F.substr(p, F.lit(1), F.lit(3)).cast("int") <= 255)))
    if kind == "card":
        return _let(_digits(text), lambda d: F.when(F.length(d) <= 19, _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(text)).between(8, 15)
    return F.lit(True)


def _found(text: Column, kind: str, pattern: str) -> Column:
    """All valid matches of a pattern: kind, start, stop, value and the text before, by start."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    nothing = F.array().cast("array<struct<start:int,stop:int,value:string>>")

    def placed(pairs: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))

        def step(state: Column, pair: Column) -> Column:
            begin = state["at"] + F.length(pair["gap"])
            end = begin + F.length(pair["value"])
            span = F.struct(begin.alias("start"), end.alias("stop"), pair["value"].alias("value"))
            return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

        return F.aggregate(pairs, start, step, lambda state: state["spans"])

    # The gaps before the matches; the last gap has none after it.
    pairs = F.zip_with(gaps, matches, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))
    pairs = F.filter(pairs, lambda pair: pair["value"].isNotNull())
    spans = F.filter(placed(pairs), lambda span: _valid(kind, span["value"]))
    spans = F.transform(spans, lambda span: F.struct(
        F.lit(kind).alias("kind"), span["start"].alias("start"), span["stop"].alias("stop"),
        span["value"].alias("value"),
        F.substr(text, F.greatest(span["start"] - _BEFORE, F.lit(0)) + 1, F.least(span["start"], F.lit(_BEFORE)))
        .alias("before")))
    worth = F.contains(text, F.lit(_NEEDS[kind])) if kind in _NEEDS else text.rlike(pattern)
    return F.when(worth, spans).otherwise(F.array().cast(
        "array<struct<kind:string,start:int,stop:int,value:string,before:string>>"))


def candidates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, row_hash, spans) per row: base matches and other candidates that overlap none of them."""
    rows = documents.select(F.col(id_column).alias("id"), F.xxhash64(id_column, text_column).alias("row_hash"),
                            F.coalesce(text_column, F.lit("")).alias("text"))
    text = F.col("text")
    base = F.concat(*[_found(text, kind, pattern) for kind, pattern in BASE.items()])
    more = F.concat(*[_found(text, kind, pattern) for kind, pattern in MORE.items()])
    apart = _let(base, lambda known: F.concat(known, F.filter(more, lambda span: ~F.exists(
        known, lambda b: (b["start"] < span["stop"]) & (span["start"] < b["stop"])))))
    return rows.select("id", "row_hash", apart.alias("spans"))


def votes(kind: Column, value: Column, before: Column) -> dict[str, Column]:
    """Each labeler's vote on a span: 1 for personal, -1 against, 0 to abstain."""
    digits = _digits(value)
    no, yes, none = F.lit(-1), F.lit(1), F.lit(0)
    return {
        "shape": F.when(kind != "number", yes).when(value.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), yes)
        .when(value.rlike(r"^\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}$"), yes)
        .when(F.length(digits) < 7, no).otherwise(none),
        "gazetteer": F.when(kind == "email", F.when(F.lower(F.element_at(F.split(value, "\\."), -1)).isin(ENDINGS), yes)
                            .otherwise(none))
        .when(kind == "card", F.when(digits.rlike(ISSUERS), yes).otherwise(no))
        .when(kind == "phone", F.when(value.rlike(CALLING), yes).otherwise(no))
        .when(kind == "ip", F.when(value.rlike(r"^(0|127|255)\."), no).otherwise(none)).otherwise(none),
        "context": F.when(before.rlike(PERSONAL), yes).otherwise(none),
        "counter": F.when(before.rlike(IMPERSONAL), no).when(value.rlike(r"^(19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}$"), no)
        .otherwise(none),
    }


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> tuple[float, list[dict]]:
    """The share of personal spans and, per labeler, P(vote | truth), by EM over (votes, count).

    Starts from the majority. Every probability gets one extra count per vote, and a labeler that votes is taken to
    be right more often than not, which settles which of the two classes is which.
    """
    truth = [0.5 + 0.45 * math.copysign(1, s) if (s := sum(votes_)) else 0.5 for votes_, _ in patterns]
    share, tables = 0.5, []
    for _ in range(rounds):
        total = sum(count for _, count in patterns)
        share = min(0.99, max(0.01, (sum(p * n for p, (_, n) in zip(truth, patterns)) + 1) / (total + 2)))
        tables = []
        for k in range(len(LABELERS)):
            table = {}
            for vote in (-1, 0, 1):
                for side in (0, 1):
                    mine = [(p if side else 1 - p) * n for p, (v, n) in zip(truth, patterns)]
                    hits = sum(m for m, (v, _) in zip(mine, patterns) if v[k] == vote)
                    table[vote, side] = (hits + 1) / (sum(mine) + 3)
            for vote, side in ((1, 1), (-1, 0)):
                table[vote, side] = max(table[vote, side], 1.5 * table[vote, 1 - side])
            tables.append(table)
        truth = [posterior(votes_, share, tables) for votes_, _ in patterns]
    return share, tables


def posterior(votes_: tuple[int, ...], share: float, tables: list[dict]) -> float:
    odds = math.log(share / (1 - share))
    odds += sum(math.log(table[vote, 1] / table[vote, 0]) for table, vote in zip(tables, votes_))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def _features(span: Column) -> Column:
    """A span's shape and context, as strings of which there are a few hundred."""
    value, before = span["value"], span["before"]
    last = F.lower(F.regexp_extract(before, r"(\w+)\W*$", 1))
    return F.array(
        F.concat(F.lit("kind "), span["kind"]),
        F.concat_ws(" ", F.lit("digits"), span["kind"], F.length(_digits(value))),
        F.concat(F.lit("signs "), F.substr(F.regexp_replace(value, "[0-9A-Za-z]", ""), F.lit(1), F.lit(3))),
        F.concat_ws(" ", F.lit("word"), F.pmod(F.xxhash64(last), F.lit(64))),
        F.concat(F.lit("cue "), before.rlike(PERSONAL).cast("string"), before.rlike(IMPERSONAL).cast("string")))


def _weights(counts: list) -> dict[str, float]:
    """Naive Bayes log-odds by feature from soft labels; '' holds the prior's."""
    weights, by_kind = {}, {}
    for row in counts:
        by_kind.setdefault(row.feature.split(" ")[0], []).append(row)
    for rows in by_kind.values():
        yes, all_ = sum(r.yes for r in rows), sum(r.n for r in rows)
        weights[""] = math.log((yes + 1) / (all_ - yes + 1))
        for r in rows:
            weights[r.feature] = math.log((r.yes + 1) / (yes + len(rows))) \
                - math.log((r.n - r.yes + 1) / (all_ - yes + len(rows)))
    return weights


def personal_data(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, spans) per row; spans is an array of (kind, start, stop) in code points, by KINDS, then start.

    Null texts count as empty; every row comes back, repeated ones each with their result; an empty table gives an
    empty result. Labelers and classifier are fitted on the candidates of the whole table.
    """
    each = pinned(candidates(documents, id_column, text_column))
    spans = each.select(F.explode("spans").alias("span"))
    vote = votes(F.col("span.kind"), F.col("span.value"), F.col("span.before"))
    voted = spans.select("span", *[vote[name].alias(name) for name in LABELERS])
    patterns = [(tuple(row[name] for name in LABELERS), row["count"])
                for row in voted.groupBy(*LABELERS).count().collect()]
    kinds = [F.lit(kind) for kind in KINDS]
    weights = {"": 0.0}
    if patterns:
        share, tables = reliabilities(patterns)
        known = F.create_map(*[F.lit(x) for votes_, _ in patterns
                               for x in (",".join(map(str, votes_)), posterior(votes_, share, tables))])
        soft = voted.select(F.explode(_features(F.col("span"))).alias("feature"),
                            known[F.concat_ws(",", *LABELERS)].alias("p"))
        weights |= _weights(soft.groupBy("feature").agg(F.sum("p").alias("yes"), F.count("*").alias("n")).collect())
    by_feature = F.create_map(*[F.lit(x) for item in weights.items() for x in item])

    def kept(span: Column) -> Column:
        odds = F.aggregate(_features(span), F.lit(weights[""]),
                           lambda sum_, feature: sum_ + F.coalesce(by_feature[feature], F.lit(0.0)))
        return span["kind"].isin(list(BASE)) | (odds > 0)

    chosen = F.transform(F.filter("spans", kept), lambda span: F.struct(
        F.array_position(F.array(*kinds), span["kind"]).alias("place"), span["start"].cast("long").alias("start"),
        span["stop"].cast("long").alias("stop"), span["kind"].alias("kind")))
    return each.select("id", F.transform(F.array_sort(chosen), lambda span: F.struct(
        span["kind"].alias("kind"), span["start"].alias("start"), span["stop"].alias("stop"))).alias("spans"))

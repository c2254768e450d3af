"""Personal data by weak supervision.

Candidate spans come from patterns: strict ones for e-mail addresses, IP addresses, card and phone
numbers, and loose ones for phone numbers without a country code and for addresses that are spelled
out. Five labelers vote on each candidate, for (1), against (-1) or not at all (0):

* form: the strict pattern matches, or only the loose one does;
* check: the Luhn sum, the range of the parts, the number of digits, the ending of the mail domain;
* gazetteer: the words or digits inside are those that such data begin or end with;
* context: the words before name such data, or name something else that is numbered;
* edge: the span is not part of a longer word or number.

Candidates are counted by kind and votes. Expectation-maximisation over these counts, of which there
are at most kinds * 3^5, estimates how reliable each labeler is for each kind and how likely each
pattern of votes is personal data. With these as soft labels a naive Bayes classifier over the votes
and the span's own features (length, digits, line position) is trained by aggregation, and it decides
on the loose candidates. Strict matches that pass their check always stay.

The main path is DataFrame functions only. A document's candidates stay in its row; only counts are
shuffled. Positions are code points, ends exclusive. Patterns are anchored or possessive, so matching
takes linear time in texts without blanks, too.

Defined cases: a null text is an empty one; an empty text has no spans; a table without candidates
leaves the classifier at its priors; repeated rows get equal spans; extra columns do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import table
from riskloom.session import materialize

# The kinds in their order and what makes a match of each.
KINDS = ["email", "ip", "card", "phone"]
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Loose forms are found beside the strict ones and kept only if the classifier says so.
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++ ?[(\[]at[)\]] ?[a-z0-9-]++(?: ?[(\[]dot[)\]] ?[a-z0-9-]++)++",
    "phone": r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])",
}
# Word lists of the labelers.
MAIL_ENDS = ["com", "org", "net", "edu", "info", "io", "de", "fr", "es", "uk"]
CARD_STARTS = ["34", "37", "4", "51", "52", "53", "54", "55", "6011", "65"]
CUES = {
    "email": ["e-mail", "email", "mail", "contact", "write", "kontakt", "correo", "courriel"],
    "ip": ["ip", "address", "host", "server", "login", "from"],
    "card": ["card", "visa", "mastercard", "credit", "karte", "tarjeta", "carte"],
    "phone": ["phone", "tel", "call", "fax", "mobile", "telefon", "tél", "teléfono"],
}
NUMBERED = ["version", "isbn", "issn", "section", "chapter", "page", "order", "item", "no", "id"]
LABELERS = ["form", "check", "gazetteer", "context", "edge"]
FEATURES = ["size", "digits", "opens"]
ROUNDS, SMOOTH = 25, 1.0

_CONTEXT = 40
_SPAN = "struct<start:int,end:int,body:string,before:string,after:string>"


def _matches(text: str, pattern: str) -> Column:
    return F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))


#: Items that a running total takes at a time, see `_running`.
_PIECE = 256


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, also where lambdas read it again and again."""
    return F.transform(F.array(value), body)[0]


def _pieces(items: Column) -> Column:
    """An array cut into arrays of at most _PIECE items."""
    last = F.floor((F.size(items) - 1) / _PIECE).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.slice(items, k * _PIECE + 1, F.lit(_PIECE)))
    return F.when(F.size(items) > 0, cut).otherwise(F.slice(cut, 1, 0))


def _running(items: Column, zero: Column, step) -> Column:
    """For each item the total of those before it; `step` adds two totals, of which items are single ones.

    Appending to an array copies it, so totals are found in pieces: first of whole pieces, then inside each.
    """
    kind = "array<int>"
    begin = lambda at: F.struct(at.alias("at"), F.array().cast(kind).alias("out"))
    add = lambda total, x: F.struct(step(total["at"], x).alias("at"), F.concat(total["out"], F.array(total["at"])).alias("out"))
    scan = lambda xs, at: F.aggregate(xs, begin(at), add, lambda total: total["out"])

    def in_pieces(pieces: Column) -> Column:
        return F.flatten(F.zip_with(pieces, scan(F.transform(pieces, lambda piece: F.aggregate(piece, zero, step)), zero), scan))

    return _let(items, lambda xs: _let(_pieces(xs), in_pieces))


def _spans(text: str, found: str, pattern: str) -> Column:
    """Spans of the matches in column `found`, from the lengths of the matches and of the gaps between them."""
    none = F.array().cast(f"array<{_SPAN}>")

    def span(x: Column) -> Column:
        begin = x["at"] + F.length(x["gap"])
        nearby = F.substring(x["gap"], -_CONTEXT, _CONTEXT)
        return F.struct(
            begin.alias("start"), (begin + F.length(x["body"])).alias("end"), x["body"].alias("body"), nearby.alias("before"), x["after"].alias("after")
        )

    def placed(gaps: Column) -> Column:
        before = F.slice(gaps, 1, F.size(found))
        after = F.transform(F.slice(gaps, 2, F.size(found)), lambda gap: F.substring(gap, 1, 1))
        lengths = F.zip_with(before, F.col(found), lambda gap, body: F.length(gap) + F.length(body))
        starts = _running(lengths, F.lit(0), lambda a, b: a + b)
        zipped = F.arrays_zip(before.alias("gap"), F.col(found).alias("body"), after.alias("after"), starts.alias("at"))
        return F.transform(zipped, span)

    return F.when(F.size(found) > 0, _let(F.split(F.col(text), pattern, -1), placed)).otherwise(none)


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    signs = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    weighed = F.transform(signs, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(F.filter(weighed, lambda d: d.isNotNull()), F.lit(0), lambda a, d: a + d) % 10 == 0


def passes(kind: str, body: Column) -> Column:
    """Whether a match of the kind's strict pattern is a base span."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.transform(F.split(body, r"\."), lambda part: F.ltrim(part, F.lit("0")))
        return F.forall(parts, lambda part: (F.length(part) < 3) | ((F.length(part) == 3) & (part <= "255")))
    digits = _digits(body)
    if kind == "card":
        return F.length(digits).between(14, 19) & _luhn(digits)
    return F.length(digits).between(10, 15)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(good, 1).when(bad, -1).otherwise(0)


def _judged(kind: str, span: Column, strict: bool) -> Column:
    """A candidate with the votes of the labelers and its features."""
    body, before, after = span["body"], F.lower(span["before"]), span["after"]
    digits = _digits(body)
    if kind == "email":
        end = F.lower(F.regexp_extract(body, r"([A-Za-z0-9-]+)\s*$", 1))
        check, known = F.length(end) >= 2, end.isin(MAIL_ENDS)
        inner = F.lit(False)
    else:
        check = passes(kind, body)
        if kind == "ip":
            known, inner = F.regexp_like(body, F.lit(r"^(?:10|127|192\.168)\.")), F.regexp_like(body, F.lit(r"^0"))
        elif kind == "card":
            known, inner = F.regexp_like(digits, F.lit("^(?:" + "|".join(CARD_STARTS) + ")")), F.regexp_like(digits, F.lit("^0"))
        else:
            known, inner = F.regexp_like(body, F.lit(r"^\+|^\([2-9]|^[2-9]")), F.regexp_like(digits, F.lit("^0+$"))
    words = lambda names: F.regexp_like(before, F.lit(r"\b(?:" + "|".join(names) + r")\b[^\n]{0,20}$"))
    joined = r"[\p{L}\p{N}_]"
    opens = F.length(span["before"]) == 0
    votes = {
        "form": F.lit(1 if strict else -1),
        "check": _vote(check, ~check),
        "gazetteer": _vote(known, inner),
        "context": _vote(words(CUES[kind]), words(NUMBERED)),
        "edge": _vote(~F.regexp_like(before, F.lit(joined + "$")) & ~F.regexp_like(after, F.lit(joined)), F.regexp_like(after, F.lit(joined))),
    }
    features = {
        "size": F.least(F.floor(F.length(body) / 5), F.lit(8)).cast("int"),
        "digits": F.floor(4 * F.length(digits) / F.length(body)).cast("int"),
        "opens": opens.cast("int"),
    }
    base = passes(kind, body) if strict else F.lit(False)
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), span["start"].alias("start"), span["end"].alias("end"), base.alias("base"), F.lit(strict).alias("strict"),
        *[v.cast("int").alias(k) for k, v in votes.items()], *[F.coalesce(v, F.lit(0)).alias(k) for k, v in features.items()],
    )


def _judge(kind: str, strict: bool):
    return lambda span: _judged(kind, span, strict)


def of_kind(number: int):
    return lambda span: span["kind"] == number


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored (id, spans): all candidates of each document with their votes and features."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    forms = [(kind, True, pattern) for kind, pattern in STRICT.items()] + [(kind, False, pattern) for kind, pattern in LOOSE.items()]
    names = [f"{kind}_{'strict' if strict else 'loose'}" for kind, strict, _ in forms]
    found = rows.select("id", "text", *[_matches("text", pattern).alias(name) for name, (_, _, pattern) in zip(names, forms)])
    spans = found.select("id", *[_spans("text", name, pattern).alias(name) for name, (_, _, pattern) in zip(names, forms)])
    judged = [F.transform(name, _judge(kind, strict)) for name, (kind, strict, _) in zip(names, forms)]
    return materialize(spans.select("id", F.concat(*judged).alias("spans")), "pii-candidates")


def reliabilities(counts: list[tuple]) -> dict[tuple, float]:
    """How likely each (kind, *votes) is personal data, by expectation-maximisation over the counts of patterns.

    A labeler has, for each kind, the chances of its three votes on personal data and on other spans;
    labelers are independent given which of the two a span is.
    """
    chance: dict[tuple, float] = {}
    for kind in sorted({row[0] for row in counts}):
        patterns = [(row[1 : 1 + len(LABELERS)], row[-1]) for row in counts if row[0] == kind]
        # Start from the share of votes for among the votes cast.
        soft = {votes: min(0.95, max(0.05, 0.5 + 0.5 * sum(votes) / max(1, sum(map(abs, votes))))) for votes, _ in patterns}
        total = sum(n for _, n in patterns)
        for _ in range(ROUNDS):
            mass = [SMOOTH + sum(n * soft[v] for v, n in patterns), SMOOTH + sum(n * (1 - soft[v]) for v, n in patterns)]
            rates = [
                [
                    {
                        vote: (SMOOTH + sum(n * (soft[v] if side == 0 else 1 - soft[v]) for v, n in patterns if v[i] == vote)) / (mass[side] + 3 * SMOOTH)
                        for vote in (-1, 0, 1)
                    }
                    for i in range(len(LABELERS))
                ]
                for side in (0, 1)
            ]
            for votes, _ in patterns:
                logs = [math.log(mass[side] / (total + 2 * SMOOTH)) + sum(math.log(rates[side][i][v]) for i, v in enumerate(votes)) for side in (0, 1)]
                soft[votes] = 1 / (1 + math.exp(min(60.0, logs[1] - logs[0])))
        chance.update({(kind, *votes): p for votes, p in soft.items()})
    return chance


def classifier(spans: DataFrame) -> tuple[dict[int, float], dict[tuple, float]]:
    """Log odds of each kind, and of each (kind, feature, value), from candidates with EM's labels."""
    names = LABELERS + FEATURES
    # At most kinds * 3^5 votes times kinds of features: the counts of a small closed table.
    rows = spans.select(F.explode("spans").alias("s")).select("s.kind", *[f"s.{name}" for name in names])
    counted = [tuple(row) for row in rows.groupBy("kind", *names).count().collect()]
    by_votes: dict[tuple, int] = {}
    for row in counted:
        key = row[: 1 + len(LABELERS)]
        by_votes[key] = by_votes.get(key, 0) + row[-1]
    soft = reliabilities([(*key, n) for key, n in sorted(by_votes.items())])
    mass: dict[int, list[float]] = {}
    cells: dict[tuple, list[float]] = {}
    for row in counted:
        p, n = soft[row[: 1 + len(LABELERS)]], row[-1]
        for held in [mass.setdefault(row[0], [SMOOTH, SMOOTH])] + [cells.setdefault((row[0], name, row[1 + i]), [SMOOTH, SMOOTH]) for i, name in enumerate(names)]:
            held[0] += n * p
            held[1] += n * (1 - p)
    odds = {kind: math.log(yes / no) for kind, (yes, no) in mass.items()}
    weights = {}
    for (kind, name, value), (yes, no) in cells.items():
        weights[(kind, name, value)] = math.log(yes / no) - odds[kind]
    return odds, weights


def _score(span: Column, odds: dict[int, float], weights: dict[tuple, float]) -> Column:
    """The classifier's log odds that a span is personal data; unseen values add nothing."""
    prior = F.create_map(*[F.lit(x) for kind in range(len(KINDS)) for x in (kind, odds.get(kind, 0.0))])
    total = prior[span["kind"]]
    for name in LABELERS + FEATURES:
        known = sorted((kind * 1000 + value + 500, w) for (kind, of, value), w in weights.items() if of == name)
        if known:
            cells = F.create_map(*[F.lit(x) for pair in known for x in pair])
            total = total + F.coalesce(F.try_element_at(cells, span["kind"] * 1000 + span[name] + 500), F.lit(0.0))
    return total


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): structs of kind (its number in KINDS), start, end and base, ordered by start and kind.

    Base spans are the strict matches that pass; the others were added by the classifier. An added span
    overlaps no base span, and of overlapping ones the first is taken.
    """
    found = candidates(docs, id_col, text_col)
    odds, weights = classifier(found)
    keep = F.filter("spans", lambda s: s["base"])
    loose = F.filter("spans", lambda s: ~s["strict"] & (s["check"] == 1) & (_score(s, odds, weights) > 0))
    short = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base"))
    found = found.select("id", F.transform(keep, short).alias("base"), F.transform(loose, short).alias("loose"))

    def apart(every: Column) -> Column:
        # In the order of starts: how far base spans reach that start before a span, and where the next one starts.
        ends = F.transform(every, lambda s: F.when(s["base"], s["end"]).otherwise(0))
        reach = _running(ends, F.lit(0), lambda a, b: F.greatest(a, b))
        starts = F.transform(F.reverse(every), lambda s: F.when(s["base"], s["start"]).otherwise(_BEYOND))
        following = F.reverse(_running(starts, F.lit(_BEYOND), lambda a, b: F.least(a, b)))
        zipped = F.arrays_zip(every.alias("s"), reach.alias("reach"), following.alias("next"))
        free = F.filter(zipped, lambda x: ~x["s"]["base"] & (x["reach"] <= x["s"]["start"]) & (x["next"] >= x["s"]["end"]))
        return F.transform(free, lambda x: x["s"])

    none = F.array().cast("array<struct<start:int,kind:int,end:int,base:boolean>>")
    added = F.when(F.size("loose") > 0, _let(F.array_sort(F.concat("base", "loose")), apart)).otherwise(none)
    found = found.select("id", "base", added.alias("added"))
    return found.select(F.col("id").alias(id_col), F.array_sort(F.concat("base", _first_ones("added"))).alias("spans"))


#: A position after every text.
_BEYOND = 2**31 - 1


def _first_ones(spans: str) -> Column:
    """Of spans sorted by start those that overlap none that was taken before them."""
    kind = "array<struct<start:int,kind:int,end:int,base:boolean>>"
    none = F.array().cast(kind)

    def add(total: Column, s: Column) -> Column:
        free = total["end"] <= s["start"]
        return F.struct(
            F.when(free, s["end"]).otherwise(total["end"]).alias("end"),
            F.when(free, F.concat(total["out"], F.array(s))).otherwise(total["out"]).alias("out"),
        )

    def add_piece(total: Column, piece: Column) -> Column:
        done = F.aggregate(piece, F.struct(total["end"].alias("end"), none.alias("out")), add)
        return F.struct(done["end"].alias("end"), F.concat(total["out"], F.array(done["out"])).alias("out"))

    start = F.struct(F.lit(0).alias("end"), F.array().cast(f"array<{kind}>").alias("out"))
    taken = lambda pieces: F.flatten(F.aggregate(pieces, start, add_piece, lambda total: total["out"]))
    return _let(_pieces(F.col(spans)), taken)


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    found = found.select("doc_id", "spans", base.alias("base"))
    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))

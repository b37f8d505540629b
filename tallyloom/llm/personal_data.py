"""Personal data in texts, by labelers that vote and a classifier trained on what their votes imply.

Patterns propose spans.  The four base kinds are spans by rule and always stay; the others are
candidates.  Each span gets votes of yes, no or nothing:

* form: the span's own shape, with checksums where the kind has one;
* gazetteer: known endings, prefixes, country codes, given names, and known dummies;
* context: words to the left that announce the kind, or something else that looks like it;
* edge: whether the span stands alone or inside a longer token;
* variety: runs of one character or of counting digits are made up;
* company: whether the text holds another kind of span nearby.

Nobody labels anything.  Expectation-maximisation over the counts of vote patterns estimates each
labeler's hit rate and false alarm rate and each kind's share (the Dawid and Skene model), and gives
each pattern its probability.  A logistic model over the span's own features (kind, length, digits, edges,
announcing words, variety) is trained on these probabilities and decides on the candidates.

All of it runs in the JVM.  Texts are read once; what is stored per document is its spans.  The driver
sees counts of vote patterns and of feature values, whose number the lists below bound.  Positions are
running sums over blocks of the root of their number, so texts with very many spans stay cheap.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.llm.registry import query, table
from tallyloom.llm.text import let
from tallyloom.session import durable

# The base patterns' character classes, written so that no text makes them back up.
# A local part is tried at its first character only, or where the last match ended; the rest of it
# could only lead to the same @.
_LOCAL, _HOST = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_AT, _DOT = r"\x20?[(\[{](?:at|AT)[)\]}]\x20?", r"\x20?[(\[{](?:dot|DOT)[)\]}]\x20?"
GIVEN_NAMES = (
    "Alice Anna Antonio Barbara Carlos Charlotte Claire David Elizabeth Emma Francois Hans Heinrich James Javier Jean "
    "John Jose Juan Julia Karl Laura Louise Lucia Luis Maria Marie Martin Mary Michael Patricia Paul Peter Pierre Robert "
    "Sarah Sofia Sophie Susan Thomas Ursula William Wolfgang"
).split()
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Mme Monsieur Madame Senor Senora".split()
IBAN_COUNTRIES = "AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MT NL NO PL PT RO SE SI SK".split()
TOP_DOMAINS = "com org net edu gov info io de fr es it uk at ch nl be pt br mx eu".split()
COUNTRY_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 86 90 91 351 352 353 358 420".split()
DUMMIES = "changeme example placeholder password none null test secret yourpassword xxxxxxxx".split()


@dataclass(frozen=True)
class Pattern:
    """``kind`` with its pattern; ``marks`` are texts of which one must occur for a match, and so must a digit."""

    kind: str
    regex: str
    marks: tuple[str, ...] = ()
    base: bool = False
    digit: bool = False


PATTERNS = (
    Pattern("email", EMAIL, ("@",), True),
    Pattern("ip", IP, (".",), True, True),
    Pattern("card", CARD, (), True, True),
    Pattern("phone", PHONE, ("+",), True, True),
    Pattern("secret", r"(?<=[=:])(?<=(?:pass|[Pp]assword|[Pp]asswd|[Pp]wd|[Ss]ecret|[Tt]oken|[Aa]pi_?[Kk]ey)[=:])[\x21-\x7E]{6,}+", ("=", ":")),
    Pattern("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", digit=True),
    Pattern("national-id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", ("-",), digit=True),
    Pattern("mac", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}(?![0-9A-Fa-f:])", (":",)),
    Pattern("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++{_AT}{_HOST}++(?:(?:{_DOT}|\.){_HOST}++)++", ("at)", "at]", "at}", "AT)", "AT]", "AT}")),
    Pattern("phone", r"(?<![0-9+.-])(?:\([0-9]{2,5}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])", digit=True),
    Pattern(
        "person",
        rf"(?=[A-Z])(?<![A-Za-z])(?:(?:{'|'.join(TITLES)})\.?\x20[A-Z][a-z]{{1,20}}(?:\x20[A-Z][a-z]{{1,20}})?|"
        rf"(?:{'|'.join(GIVEN_NAMES)})\x20[A-Z][a-z]{{1,20}})(?![A-Za-z])",
    ),
)
KINDS = tuple(dict.fromkeys(p.kind for p in PATTERNS))
BASE_KINDS = tuple(p.kind for p in PATTERNS if p.base)

# Words that announce a kind, within the characters before a span, and words that
# announce numbers of another sort.
CUES = {
    "email": "mail contact write reach correo courriel", "ip": "ip address host server client login adresse",
    "card": "card visa mastercard amex credit karte tarjeta carte", "phone": "phone tel call mobile fax cell telefon telefono",
    "secret": "user login key credentials pass password token secret", "iban": "iban account konto cuenta compte bank",
    "national-id": "ssn social security id number", "mac": "mac device hardware ethernet wlan", "person": "name called signed regards dear by sincerely",
}
OTHER_CUES = "version release isbn issn order invoice item page figure chapter section build ticket part"
LEFT = 24  # characters to the left that are looked at
NEAR = 160  # characters between spans that keep each other company

NOTHING, NO, YES = 0, 1, 2
LABELERS = ("form", "gazetteer", "context", "edge", "variety", "company")
FEATURES = (("kind", len(KINDS)), ("length", 7), ("digits", 5), ("left", 4), ("right", 4), ("cue", 3), ("variety", 4), ("form", 2))
#: Where the classifier's weights start and are drawn to, so that values never seen in training still count.
PRIOR = {("left", 2): -2.0, ("right", 2): -2.0, ("cue", NO): -2.0, ("cue", YES): 1.0, ("variety", 0): -2.0, ("form", 0): -2.0}
THRESHOLD = 0.5


def running(values: Column, merge: Callable[[Column, Column], Column], start: Column) -> Column:
    """For each place of an array ``start`` merged with all values up to it, that one included.

    Blocks of the root of the number of values: the work grows with its power of 1.5.
    """

    def fold(part: Column) -> Column:
        return F.aggregate(part, start, merge)

    def whole(v: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(v))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), ((F.size(v) - 1) / size).cast("int")), lambda b: F.slice(v, b * size + 1, size))

        def spread(parts: Column) -> Column:
            before = let(F.transform(parts, fold), lambda sums: F.transform(sums, lambda s, b: fold(F.slice(sums, F.lit(1), b))))
            return let(before, lambda so_far: F.flatten(F.transform(
                parts, lambda part, b: F.transform(part, lambda x, i: merge(F.get(so_far, b), fold(F.slice(part, F.lit(1), i + 1)))),
            )))

        return let(blocks, spread)

    return let(values, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(v))


def _added(a: Column, b: Column) -> Column:
    return a + b


def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _smaller(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _plain_digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a text of digits has a right check digit."""

    def value(c: Column, i: Column) -> Column:
        twice = c.cast("int") * (i % 2 + 1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    each = F.transform(F.split(F.reverse(digits), ""), value)
    return F.aggregate(each, F.lit(0), _added) % 10 == 0


def _remainder_97(hit: Column) -> Column:
    """An account number's remainder: the first four characters last, letters as 10 to 35."""
    bare = F.regexp_replace(hit, " ", "")
    turned = F.concat(F.substring(bare, 5, 99), F.substring(bare, 1, 4))

    def step(so_far: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 65, (so_far * 10 + code - 48) % 97).otherwise((so_far * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _passes(s: Column) -> Column:
    """The base kinds' own conditions on a match."""
    hit, digits = s["hit"], s["digits"]
    base = {
        "ip": hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"), "card": F.length(digits).between(12, 19) & _luhn(F.substring(digits, 1, 19)),
        "phone": F.length(digits).between(9, 15),
    }
    return ~s["base"] | _by_kind(s["kind"], base, F.lit(True))


def _placed(p: Column) -> Column:
    """A pattern's matches with places in code points and the characters around them."""
    hits, gaps = p["hits"], p["gaps"]
    steps = F.transform(hits, lambda h, i: F.length(F.get(gaps, i)) + F.when(i > 0, F.length(F.get(hits, i - 1))).otherwise(0))
    return let(running(steps, _added, F.lit(0)), lambda starts: F.transform(hits, lambda h, i: F.struct(
        F.get(starts, i).alias("start"), (F.get(starts, i) + F.length(h)).alias("end"), p["kind"].alias("kind"), p["base"].alias("base"),
        h.alias("hit"), _plain_digits(h).alias("digits"), F.right(F.get(gaps, i), F.lit(LEFT)).alias("left"),
        F.substring(F.get(gaps, i + 1), 1, 1).alias("right"),
    )))


def _without_overlaps(spans: Column) -> Column:
    """Spans by start without the candidates that share a character with a base span or an earlier candidate."""
    far = F.lit(2**31 - 1)

    def clear(s: Column) -> Column:
        base_ends = running(F.transform(s, lambda x: F.when(x["base"], x["end"]).otherwise(0)), _larger, F.lit(0))
        back = F.reverse(F.transform(s, lambda x: F.when(x["base"], x["start"]).otherwise(far)))
        base_starts = F.reverse(running(back, _smaller, far))
        return let(base_ends, lambda ends: let(base_starts, lambda starts: F.filter(
            s, lambda x, i: x["base"] | ((F.get(ends, i) <= x["start"]) & (F.get(starts, i) >= x["end"]))
        )))

    def first(s: Column) -> Column:
        ends = running(F.transform(s, lambda x: x["end"]), _larger, F.lit(0))
        return let(ends, lambda e: F.filter(s, lambda x, i: x["base"] | (i == 0) | (F.get(e, i - 1) <= x["start"])))

    ordered = F.array_sort(spans)
    added = F.exists(spans, lambda x: ~x["base"])
    return F.when(added, let(let(ordered, clear), first)).otherwise(ordered)


def _any_of(words: str) -> str:
    return rf"(?i)(?<![a-z])(?:{'|'.join(words.split())})(?![a-z])"


def _by_kind(kind: Column, cases: dict[str, Column], otherwise: Column) -> Column:
    chosen = None
    for name, value in cases.items():
        test = kind == KINDS.index(name)
        chosen = F.when(test, value) if chosen is None else chosen.when(test, value)
    return chosen.otherwise(otherwise)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, YES).when(no, NO).otherwise(NOTHING)


def _cue(s: Column) -> Column:
    announced = _by_kind(s["kind"], {k: s["left"].rlike(_any_of(words)) for k, words in CUES.items()}, F.lit(False))
    return _vote(announced, s["left"].rlike(_any_of(OTHER_CUES)))


def _edge(c: Column) -> Column:
    """0 nothing or white space, 1 punctuation, 2 a letter, digit or mark of a longer token, 3 other."""
    return F.when((c == "") | c.rlike(r"^\s"), 0).when(c.rlike(r"^[.,;:!?()\[\]\"'<>]"), 1).when(c.rlike(r"^[A-Za-z0-9_/@#=&%+-]"), 2).otherwise(3)


def _variety(hit: Column) -> Column:
    """Distinct letters and digits: 0 up to two, 1 up to four, 2 up to eight, 3 more."""
    n = F.size(F.array_distinct(F.split(F.regexp_replace(F.lower(hit), "[^a-z0-9]", ""), "")))
    return F.when(n <= 2, 0).when(n <= 4, 1).when(n <= 8, 2).otherwise(3)


def _looked_at(s: Column) -> Column:
    """A span with what its own characters and those around it say."""
    hit, digits = s["hit"], s["digits"]
    form = _by_kind(s["kind"], {
        "email": hit.rlike(r"[.)\]}]\x20?[A-Za-z]{2,24}$"), "ip": ~hit.rlike(r"(?:^|\.)0[0-9]|^0\.|^255\."),
        "card": F.length(digits).between(13, 19), "phone": F.length(digits).between(9, 13),
        "secret": hit.rlike("[0-9]") & hit.rlike("[A-Za-z]") & (F.length(hit) >= 8), "iban": _remainder_97(hit) == 1,
        "national-id": ~hit.rlike("^(?:000|666|9..)|-00-|-0000$"), "person": hit.rlike(r"\x20[A-Z][a-z]{2,}"),
    }, F.lit(True))
    ending = F.lower(F.regexp_extract(hit, r"([A-Za-z]+)$", 1))
    gazetteer = _by_kind(s["kind"], {
        "email": _vote(ending.isin(TOP_DOMAINS), F.lit(False)), "ip": _vote(F.lit(False), hit.rlike(r"^(?:127|10|192\.168)\.")),
        "card": _vote(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)"), digits.rlike("^[0189]")),
        "phone": _vote(hit.rlike(rf"^\+(?:{'|'.join(COUNTRY_CODES)})"), digits.rlike("^0000")),
        "secret": _vote(F.lit(False), F.lower(hit).isin(DUMMIES)),
        "iban": F.when(F.substring(hit, 1, 2).isin(IBAN_COUNTRIES), YES).otherwise(NO),
        "national-id": _vote(F.lit(False), hit.isin("123-45-6789", "078-05-1120", "219-09-9999")),
        "person": _vote(hit.rlike(rf"(?:{'|'.join(GIVEN_NAMES)})"), F.lit(False)),
    }, F.lit(NOTHING))
    # What stands before a secret is its own announcement.
    before = F.when(s["kind"] == KINDS.index("secret"), 0).otherwise(_edge(F.right(s["left"], F.lit(1))))
    return F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base"),
        F.length(hit).alias("length"), F.length(digits).alias("digits"), before.alias("before"), _edge(s["right"]).alias("after"),
        _cue(s).alias("cue"), _variety(hit).alias("variety"), form.alias("form"), gazetteer.alias("gazetteer"),
        ((F.length(digits) >= 6) & F.lit("01234567890123456789").contains(F.substring(digits, 1, 20))).alias("counting"),
    )


def _described(spans: Column) -> Column:
    """Spans with their votes as one number in base three and their features as numbers."""

    def company(x: Column, other: Column, gap: Column) -> Column:
        return F.coalesce((other["kind"] != x["kind"]) & (gap <= NEAR), F.lit(False))

    def one(x: Column, i: Column) -> Column:
        before, after = F.get(spans, i - 1), F.get(spans, i + 1)
        near = company(x, before, x["start"] - before["end"]) | company(x, after, after["start"] - x["end"])
        inside = (x["before"] == 2) | (x["after"] == 2)
        votes = (
            F.when(x["form"], YES).otherwise(NO), x["gazetteer"], x["cue"], F.when(inside, NO).otherwise(YES),
            F.when((x["variety"] == 0) & (x["length"] > 6) | x["counting"], NO).otherwise(NOTHING), F.when(near, YES).otherwise(NOTHING),
        )
        code = sum((v * 3**n for n, v in enumerate(votes)), F.lit(0))
        length = F.least(F.lit(6), F.floor(F.log2(x["length"].cast("double")))).cast("int")
        share = F.floor(x["digits"] * 4 / x["length"]).cast("int")
        return F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["base"].alias("base"), code.alias("votes"),
            F.array(x["kind"], length, share, x["before"], x["after"], x["cue"], x["variety"],
                    F.when(x["form"], 1).otherwise(0)).alias("features"),
        )

    return F.transform(spans, one)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, spans``, base spans and candidates with votes and features.

    Null and empty texts have none.  Repeated rows come out as often as they came in, and ``docs`` may
    hold any other columns.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("*", F.col("text").rlike("[0-9]").alias("digit"))
    none = F.array().cast("array<string>")
    hits = []
    for n, p in enumerate(PATTERNS):
        found = F.regexp_extract_all("text", F.lit(p.regex), F.lit(0))
        marked = F.lit(not p.marks)
        for mark in p.marks:
            marked = marked | F.contains("text", F.lit(mark))
        found = F.when(F.col("digit") & marked if p.digit else marked, found).otherwise(none)
        hits.append(found.alias(f"hits{n}"))
    rows = rows.select("doc_id", "text", *hits)
    found = F.array(*(
        F.struct(
            F.col(f"hits{n}").alias("hits"), F.when(F.size(f"hits{n}") > 0, F.split("text", p.regex, -1)).alias("gaps"),
            F.lit(KINDS.index(p.kind)).alias("kind"), F.lit(p.base).alias("base"),
        )
        for n, p in enumerate(PATTERNS)
    ))
    rows = rows.select("doc_id", F.filter(found, lambda p: F.size(p["hits"]) > 0).alias("found"))
    rows = rows.select("doc_id", F.filter(F.flatten(F.transform("found", _placed)), _passes).alias("spans"))
    rows = rows.select("doc_id", _without_overlaps(F.col("spans")).alias("spans"))
    rows = rows.select("doc_id", F.transform("spans", _looked_at).alias("spans"))
    return rows.select("doc_id", _described(F.col("spans")).alias("spans"))


@dataclass(frozen=True)
class Model:
    """``rates``: for each labeler the chance of a yes on true and on false spans; ``weights`` by feature and value."""

    rates: dict[str, tuple[float, float]]
    shares: dict[str, float]
    bias: float
    weights: tuple[tuple[float, ...], ...]

    def score(self, features: Column) -> Column:
        total = F.lit(self.bias)
        for n, own in enumerate(self.weights):
            total = total + F.get(F.array(*(F.lit(w) for w in own)), F.get(features, n))
        return 1 / (1 + F.exp(-total))


def estimate(kinds: np.ndarray, votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pattern's probability, each labeler's rates of yes on true and false spans, each kind's share.

    ``votes`` is (patterns, labelers).  Starts at the share of yes among a pattern's votes; every rate
    carries a few imagined votes, so that a labeler seen rarely is neither trusted nor distrusted.
    """
    yes, no = votes == YES, votes == NO
    cast = (yes | no).sum(1)
    p = np.where(cast > 0, (yes.sum(1) + 0.5) / (cast + 1), 0.5)
    share = np.full(len(KINDS), 0.5)
    rates = np.full((votes.shape[1], 2), 0.5)
    for _ in range(rounds):
        for k in range(len(KINDS)):
            mine = kinds == k
            share[k] = ((counts * p)[mine].sum() + 1) / (counts[mine].sum() + 2)
        for side, weight in ((0, counts * p), (1, counts * (1 - p))):
            said = (weight[:, None] * yes).sum(0)
            rates[:, side] = (said + (8, 2)[side]) / (said + (weight[:, None] * no).sum(0) + 10)
        odds = np.log(share[kinds] / (1 - share[kinds]))
        odds = odds + yes @ np.log(rates[:, 0] / rates[:, 1]) + no @ np.log((1 - rates[:, 0]) / (1 - rates[:, 1]))
        p = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
    return p, rates, share


def fit(values: np.ndarray, target: np.ndarray, counts: np.ndarray, steps: int = 60, decay: float = 1.0) -> tuple[float, list[np.ndarray]]:
    """Logistic regression on one-hot features by Newton's method; ``target`` is a probability per row.

    ``decay`` draws the weights to ``PRIOR``.
    """
    sizes = [size for _, size in FEATURES]
    x = np.zeros((len(values), 1 + sum(sizes)))
    x[:, 0] = 1
    for n, (at, size) in enumerate(zip(np.cumsum([1, *sizes[:-1]]), sizes)):
        x[np.arange(len(values)), at + values[:, n]] = 1
    prior = np.array([0.0, *(PRIOR.get((name, value), 0.0) for name, size in FEATURES for value in range(size))])
    w = prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (counts * (p - target)) + decay * (w - prior)
        bend = (x * (counts * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + decay * np.eye(len(w))
        move = np.linalg.solve(bend, slope)
        w -= move * min(1.0, 4 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-8:
            break
    return float(w[0]), np.split(w[1:], np.cumsum(sizes)[:-1])


def learn(found: DataFrame) -> Model:
    """Reliabilities and classifier from all spans of stored ``candidates``."""
    spark = found.sparkSession
    spans = found.where(F.size("spans") > 0).select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.features")
    patterns = sorted((r["kind"], r["votes"], r["n"]) for r in spans.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect())
    kinds, codes, counts = (np.array([r[i] for r in patterns], dtype=np.int64) for i in range(3))
    votes = codes[:, None] // 3 ** np.arange(len(LABELERS)) % 3
    p, rates, share = estimate(kinds, votes.reshape(-1, len(LABELERS)), counts.astype(float))
    side = spark.createDataFrame([(int(k), int(v), float(x)) for (k, v, _), x in zip(patterns, p)], "kind int, votes int, p double")
    # At most kinds x 3^labelers rows.
    seen = spans.join(F.broadcast(side), ["kind", "votes"]).groupBy("features").agg(F.count("*").alias("n"), F.sum(F.col("p").cast("decimal(38,12)")).alias("p"))
    rows = sorted((tuple(r["features"]), r["n"], float(r["p"])) for r in seen.collect())
    values = np.array([r[0] for r in rows], dtype=np.int64).reshape(-1, len(FEATURES))
    n = np.array([r[1] for r in rows], dtype=float)
    bias, weights = fit(values, np.array([r[2] for r in rows]) / n if rows else n, n)
    return Model(
        {name: (float(a), float(b)) for name, (a, b) in zip(LABELERS, rates)}, dict(zip(KINDS, share.tolist())),
        bias, tuple(tuple(w.tolist()) for w in weights),
    )


def detect(found: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, spans``: structs of kind, start, end, base and score, by start, then kind as listed."""
    named = F.array(*(F.lit(k) for k in KINDS))
    scored = F.transform("spans", lambda s: F.struct(s["start"], s["kind"], s["end"], s["base"], model.score(s["features"]).alias("score")))
    kept = F.array_sort(F.filter(scored, lambda s: s["base"] | (s["score"] >= threshold)))
    return found.select("doc_id", F.when(F.size("spans") > 0, F.transform(kept, lambda s: F.struct(
        F.get(named, s["kind"]).alias("kind"), s["start"], s["end"], s["base"], s["score"],
    ))).otherwise(F.array()).alias("spans"))


def digest(detected: DataFrame) -> DataFrame:
    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["base"])
    return detected.select(
        "doc_id", *(F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )


@query("op12_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = durable(candidates(table(spark, sf_dir, "documents")), "personal-data")
    return digest(detect(found, learn(found)))

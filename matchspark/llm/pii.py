"""Personal data by weak supervision.

Candidates are the spans of email, ip, card and phone patterns that pass their checks (base spans) and the matches of
looser patterns that overlap none of those: iban, ssn and tel (a phone number without its plus sign). Five labelers vote on
each candidate, yes, no or not at all: a strict pattern, gazetteers (top-level domains, country codes, card issuers,
reserved networks), the words before it, the characters beside it, and its length. Expectation-maximisation over the counts
of all vote patterns estimates how reliable each labeler is for each kind, and with it a probability for each pattern. These
train the final classifier, a naive Bayes model of the votes, the word before and the length. Base spans stay; others are
added where the classifier gives them LEAST or more.

Everything on the rows is a DataFrame expression. What goes to the driver is one row for each kind and combination of votes
(243), length class (8) and hashed word before (64): bounded, and counted over all documents.

Null texts are empty. Rows are independent of each other but for the model, which repeated rows train as often as they
stand. A table without candidates learns nothing and adds nothing.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import free, hex_sha256, materialize
from ._spans import in_order, let, of_kind, overlap, spans, told, unmarked

LEAST, WORDS, BEFORE, ROUNDS = 0.5, 64, 32, 50
BASE, ADDED = ("email", "ip", "card", "phone"), ("iban", "ssn", "tel")
# Runs start where a match can: at the end of the last one, or where no character of the run stands before. The matches
# are those of the plain patterns, without looking at a long run once from each of its characters.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?+[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
TEL = r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
LABELERS = ("strict", "gazetteer", "context", "beside", "length")
# Top-level domains, telephone country codes, and countries whose accounts have an IBAN.
DOMAINS = tuple("com org net edu gov mil int info biz io dev app ai co me tv xyz online site shop de fr es uk it nl eu ch at be pt se dk no fi pl cz sk hu ro bg gr ie lu ru ua tr us ca mx br ar cl jp cn in kr au nz za".split())
COUNTRIES = tuple("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 98 212 213 216 234 351 352 353 354 358 359 370 371 372 380 385 386 420 421 852 886 966 971 972".split())
IBANS = tuple("AD AE AL AT AZ BA BE BG BH BR CH CR CY CZ DE DK DO EE ES FI FO FR GB GE GI GL GR GT HR HU IE IL IS IT JO KW KZ LB LI LT LU LV MC MD ME MK MR MT MU NL NO PK PL PS PT QA RO RS SA SE SI SK SM TN TR UA VG XK".split())
CUES = {
    "email": "e-?mail|mail|contact|write|correo|courriel|kontakt",
    "ip": "ip|host|address|server|login|from",
    "card": "card|visa|mastercard|amex|karte|carte|tarjeta|pay",
    "phone": "phone|call|tel|fax|mobile|cell|anruf|appel",
    "iban": "iban|account|konto|compte|cuenta|bank",
    "ssn": "ssn|social|security",
    "tel": "phone|call|tel|fax|mobile|cell|anruf|appel",
}
AGAINST = "version|release|isbn|issn|order|invoice|serial|build|chapter|section"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Of at most 19 digits."""
    each = F.transform(F.split(F.reverse(number), ""), lambda d, i: let(d.cast("int") * (i % 2 + 1), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(F.filter(each, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an IBAN without spaces has 15 to 34 characters and the right check digits: its letters as numbers, the first four characters last, leave 1 over 97."""
    each = F.split(F.concat(F.substr(account, F.lit(5)), F.substring(account, 1, 4)), "")
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.filter(each, lambda c: c != ""), F.lit(0), lambda a, c: (a * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97)
    return F.length(account).between(15, 34) & (rest == 1)


def base(text: Column) -> Column:
    """The spans of the four plain kinds, unordered, in an unmarked text."""
    part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})|0+"
    email = spans(text, EMAIL, "email", 0, F.contains(text, F.lit("@")))
    ip = F.filter(spans(text, IP, "ip", 1), lambda s: s["value"].rlike(rf"^(?:(?:{part})\.){{3}}(?:{part})$"))
    card = F.filter(spans(text, CARD, "card", 2), lambda s: let(digits(s["value"]), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False)))
    phone = F.filter(spans(text, PHONE, "phone", 3, F.contains(text, F.lit("+"))), lambda s: F.length(digits(s["value"])).between(9, 15))
    return F.concat(email, ip, card, phone)


def looser(text: Column) -> Column:
    kind = lambda v: F.when(v.rlike("^[A-Z]"), "iban").when(v.rlike("^[0-9]{3}-[0-9]{2}-"), "ssn").otherwise("tel")
    found = spans(text, f"{IBAN}|{SSN}|{TEL}", "", 4)
    return F.transform(found, lambda s: let(kind(s["value"]), lambda k: F.struct(s["start"], F.when(k == "iban", 4).when(k == "ssn", 5).otherwise(6).alias("rank"), s["end"], k.alias("kind"), s["value"])))


def votes(s: Column, before: Column, after: Column) -> list[Column]:
    """1, 0 or null by each of LABELERS for a span and the text on both its sides."""
    kind, v = s["kind"], s["value"]
    yes = lambda c: F.when(c, 1).otherwise(0)
    strict = F.when(kind == "email", yes(v.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,24}$")))
    strict = strict.when(kind == "ip", yes(v.rlike(r"^(?:0|[1-9][0-9]*)(?:\.(?:0|[1-9][0-9]*)){3}$"))).when(kind == "card", yes(v.rlike(r"^[0-9]{4}(?:[ -]?[0-9]{4}){2,3}[0-9]{0,3}$|^3[47]")))
    strict = strict.when(kind == "phone", yes(v.rlike(r"^\+[1-9]"))).when(kind == "ssn", yes(~v.rlike("^(?:000|666|9)|-00-|-0000$"))).when(kind == "tel", yes(v.rlike(r"^\(?[2-9]"))).otherwise(yes(mod97(F.replace(v, F.lit(" ")))))
    listed = F.when(kind == "email", F.when(F.lower(F.regexp_extract(v, r"\.([A-Za-z]+)$", 1)).isin(*DOMAINS), 1))
    listed = listed.when(kind == "ip", yes(~v.rlike(r"^(?:0|10|127|22[4-9]|2[3-5][0-9])\.|^192\.168\.|^172\.(?:1[6-9]|2[0-9]|3[01])\."))).when(kind == "card", yes(v.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)")))
    listed = listed.when(kind == "phone", F.when(v.rlike(rf"^\+(?:{'|'.join(COUNTRIES)})"), 1)).when(kind == "iban", yes(F.substring(v, 1, 2).isin(*IBANS)))
    cues = F.create_map(*[F.lit(x) for k, c in CUES.items() for x in (k, rf"(?i)\b(?:{c})")])
    context = F.when(before.rlike(rf"(?i)\b(?:{AGAINST})\b|\bv\.?$"), 0).when(F.regexp_like(before, F.element_at(cues, kind)), 1)
    beside = yes(~before.rlike("[A-Za-z0-9]$") & ~after.rlike("^[A-Za-z0-9]"))
    n = F.length(digits(v))
    length = F.when(kind == "email", yes(F.length(v) <= 64)).when(kind == "card", yes(n.isin(15, 16))).when(kind.isin("phone", "tel"), F.when(n.between(10, 13), 1).when(n < 9, 0))
    return [strict, listed, context, beside, length]


def candidates(text: Column) -> Column:
    """Array of spans, each with its votes (a string of 1, 0 and -), the hash of the word before, a length class, and whether it is a base span."""

    def both(t: Column) -> Column:
        def described(s: Column, is_base: bool) -> Column:
            before = F.substr(t, F.greatest(s["start"] - BEFORE, F.lit(0)) + 1, F.least(s["start"], F.lit(BEFORE)))
            after = F.substr(t, s["end"] + 1, F.lit(4))

            def body(before: Column) -> Column:
                marks = F.concat(*[F.coalesce(x.cast("string"), F.lit("-")) for x in votes(s, before, after)])
                word = F.pmod(F.xxhash64(F.lower(F.regexp_extract(before, r"(\p{L}+)\P{L}*$", 1))), F.lit(WORDS)).cast("int")
                long = F.least(F.floor(F.length(s["value"]) / 6), F.lit(7)).cast("int")
                return F.struct(s["start"], s["rank"], s["end"], s["kind"], F.lit(is_base).alias("base"), marks.alias("votes"), word.alias("word"), long.alias("long"))

            return let(before, body)

        def added(own: Column) -> Column:
            rest = F.filter(looser(t), lambda s: ~F.exists(own, lambda b: overlap(s, b)))
            return F.concat(F.transform(own, lambda s: described(s, True)), F.transform(rest, lambda s: described(s, False)))

        return in_order(let(base(t), added))

    return let(unmarked(text), both)


def fit(counts: list[tuple[str, str, int, int, int]]) -> dict[str, dict]:
    """The model of each kind from (kind, votes, word, long, n): log-odds of its prior and of each feature's value.

    EM: given a candidate's class, labelers err independently; those that don't vote are left out. Each reliability has
    the weight of five votes, four of them right, as its prior. A yes never speaks against a candidate, which keeps the classes
    from changing places; a labeler that always says yes says nothing.
    """
    by = defaultdict(lambda: defaultdict(int))
    for kind, votes_, _, _, n in counts:
        by[kind][votes_] += n
    model = {}
    for kind, patterns in by.items():
        hit = {y: [0.8] * len(LABELERS) for y in (1, 0)}
        prior = 0.5
        sure = {}
        for _ in range(ROUNDS):
            for p in patterns:
                like = {y: math.prod(hit[y][i] if v == str(y) else 1 - hit[y][i] for i, v in enumerate(p) if v != "-") for y in (1, 0)}
                sure[p] = prior * like[1] / (prior * like[1] + (1 - prior) * like[0])
            total = sum(patterns.values())
            prior = (sum(sure[p] * n for p, n in patterns.items()) + 1) / (total + 2)
            for i in range(len(LABELERS)):
                for y in (1, 0):
                    weight = {p: n * (sure[p] if y else 1 - sure[p]) for p, n in patterns.items() if p[i] != "-"}
                    right = sum(w for p, w in weight.items() if p[i] == str(y))
                    hit[y][i] = (right + 4) / (sum(weight.values()) + 5)
                hit[0][i] = max(hit[0][i], 1 - hit[1][i])
        seen = defaultdict(lambda: [1.0, 1.0])
        whole = [2.0, 2.0]
        for k, votes_, word, long, n in counts:
            if k == kind:
                p = sure[votes_]
                for f in [*(f"{i}{v}" for i, v in enumerate(votes_)), f"w{word}", f"n{long}", None]:
                    at = whole if f is None else seen[f]
                    at[0] += n * p
                    at[1] += n * (1 - p)
        odds = {f: math.log(a / whole[0]) - math.log(b / whole[1]) for f, (a, b) in seen.items()}
        model[kind] = {"prior": math.log(whole[0] / whole[1]), "odds": odds, "reliability": {name: (hit[1][i], hit[0][i]) for i, name in enumerate(LABELERS)}}
    return model


def learn(found: DataFrame, column: str = "spans") -> dict[str, dict]:
    """fit() on the counts of all candidates in a column."""
    each = found.select(F.explode(column).alias("s")).select("s.kind", "s.votes", "s.word", "s.long")
    return fit([tuple(r) for r in each.groupBy("kind", "votes", "word", "long").agg(F.count("*").alias("n")).collect()])


def accepted(found: Column, model: dict[str, dict], least: float = LEAST) -> Column:
    """Base spans and those that the classifier is sure enough of, each with its probability p."""
    pairs = [F.lit(x) for kind, m in model.items() for f, odds in [("", m["prior"]), *m["odds"].items()] for x in (f"{kind}|{f}", float(odds))]
    table = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")

    def sure(s: Column) -> Column:
        names = [F.lit(""), *(F.concat(F.lit(str(i)), F.substring(s["votes"], i + 1, 1)) for i in range(len(LABELERS))), F.concat(F.lit("w"), s["word"].cast("string")), F.concat(F.lit("n"), s["long"].cast("string"))]
        odds = sum((F.coalesce(F.try_element_at(table, F.concat(s["kind"], F.lit("|"), n)), F.lit(0.0)) for n in names), F.lit(0.0))
        return F.round(1 / (1 + F.exp(-odds)), 6)

    scored = F.transform(found, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], s["base"], sure(s).alias("p")))
    return F.filter(scored, lambda s: s["base"] | (s["p"] >= least))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans): what stands in each text, as an ordered array of (start, rank, end, kind, base, p). One scan of the texts."""
    found = materialize(docs.select(F.col(id_col).alias("id"), candidates(F.col(text_col)).alias("spans")))
    return found.select(F.col("id").alias(id_col), accepted(F.col("spans"), learn(found)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the base spans, and all spans, from personal_data()."""
    own = F.filter("spans", lambda s: s["base"])
    return found.select(found.columns[0], *[of_kind(own, k).alias(f"n_{k}") for k in BASE], hex_sha256(told(own)).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """docs with every span replaced by its kind in brackets, and length_col, if given, by the new text's code points. Overlapping spans count as the first one. Texts without spans stay as they are, null ones too. The rows are written once with their candidates, so texts are searched once; no shuffle of texts."""
    names, own = docs.columns, free("_spans", docs.columns)
    held = materialize(docs.withColumn(own, candidates(F.col(text_col))))
    model = learn(held, own)

    def cut(t: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

        def step(a: Column, s: Column) -> Column:
            tag = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
            more = F.concat(a["out"], F.substr(t, a["at"] + 1, s["start"] - a["at"]), tag)
            return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], more).otherwise(a["out"]).alias("out"))

        join = lambda a: F.concat(a["out"], F.substr(t, a["at"] + 1, F.length(t) - a["at"]))
        return let(accepted(F.col(own), model), lambda s: F.when(F.size(s) == 0, t).otherwise(F.aggregate(s, start, step, join)))

    new = F.when(F.col(text_col).isNotNull(), let(F.col(text_col), cut))
    out = held.withColumn(text_col, new).select(*names)
    return out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType)) if length_col else out

"""Personal data by weak supervision, in DataFrame functions throughout.

Candidate spans come from base patterns and from looser ones. On each candidate
labelers vote: a regex for the strict form, a gazetteer for its parts (which also
proposes names without a title), the words before it, and a check of its digits.
Matches that fail their check are candidates too, which are never kept: from them
is learned what other candidates look like. Where a labeler sees no evidence it
votes no, so that its reliability can be estimated at any size.
Votes are counted by kind and pattern of votes; expectation-maximisation over
these few counts estimates how reliable each labeler is on each kind and how
probable each pattern makes personal data. A logistic span classifier is trained
on the probabilities, with the candidates' lengths, characters, what stands before
them and the word of context there as further features, and decides on the looser candidates. Base
spans always stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slim, table, written

# Kinds in the order in which spans are listed; the first four are the base kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "local_phone", "iban", "person")

# Titles, and given names that civil registers of English, German, French and Spanish speaking countries list often.
TITLES = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señora|Señor"
NAMES = "|".join(
    (
        "Aaron Adam Adrian Agnes Alain Alan Albert Alejandro Alessandro Alex Alexander Alexandra Alfred Alice Alicia Alfonso Amanda Amélie Amy Ana Andrea Andreas Andrew André Angela Ángel Anita Ann "
        "Anna Anne Annette Anthony Antoine Antonio Arnaud Arthur Astrid Aurélie Barbara Beatriz Benjamin Bernard Bernd Bernhard Birgit Brian Brigitte Bruno Camille Carla Carlos Carmen Carol Caroline "
        "Catherine Cécile Charles Charlotte Christian Christine Christoph Christopher Claire Claudia Clara Cristina Daniel Daniela David Deborah Denis Diana Didier Diego Dieter Dirk Dominique Donald "
        "Dorothea Edith Eduardo Edward Elena Eleanor Élise Elisabeth Elizabeth Emily Emma Enrique Erik Ernst Esther Eva Fabian Fatima Felipe Felix Fernando Florian Frances Francis Francisco François "
        "Frank Franz Friedrich Gabriel Gabriela Gary George Georg Gérard Gerhard Gilles Gisela Gloria Grace Guillaume Günter Gustav Hannah Hans Harald Harry Heike Heinrich Heinz Helen Helena Helga "
        "Henri Henry Herbert Hermann Holger Hugo Ian Ignacio Ingrid Irene Isabel Isabelle Ivan Jack Jacqueline Jacques James Jan Jane Janet Jason Javier Jean Jennifer Jens Jessica Joachim Joan "
        "Joaquín Johanna Johannes John Jonas Jonathan Jörg Jorge José Joseph Juan Judith Julia Julian Julie Julien Jürgen Karen Karin Karl Katharina Kathleen Katrin Kenneth Kevin Klaus Kurt Lars "
        "Laura Laurent Léa Lena Leonardo Lisa Louis Louise Lucas Lucía Lucie Luis Luisa Lukas Manfred Manuel Manuela Marc Marcel Marco Marcos Margaret Margarita Maria María Marianne Marie Mario "
        "Marina Marion Mark Markus Marta Martha Martin Martina Mary Mathieu Matthew Matthias Max Maximilian Melanie Mercedes Michael Michel Michelle Miguel Monica Monika Mónica Nadine Nancy Natalia "
        "Nathalie Nicholas Nicolas Nicole Nina Norbert Olga Oliver Olivia Olivier Oscar Otto Pablo Pamela Pascal Patricia Patrick Paul Paula Pauline Pedro Peter Petra Philip Philipp Philippe Pierre "
        "Pilar Rachel Rafael Rainer Ralf Ramón Raúl Rebecca Regina Reinhard Renate Ricardo Richard Robert Roberto Roger Roland Rolf Rosa Rosario Rudolf Ruth Sabine Samuel Sandra Sara Sarah Sebastian "
        "Sergio Sharon Simon Simone Sofía Sonia Sophie Stefan Stefanie Stéphane Stephen Steven Susan Susanne Sven Sylvie Teresa Thérèse Thierry Thomas Thorsten Tobias Ulrich Ursula Ute Uwe Valentina "
        "Valérie Vera Verónica Vicente Victor Victoria Vincent Virginia Walter Werner William Wolfgang Yolanda Yves "
    ).split()
)
# Words after a given name that make it a place.
PLACES = "Street|Road|Avenue|Square|Park|Place|Lane|Platz|Allee|Weg|Rue|Avenida|Plaza|River|County|Hall|Church|University"
# The patterns. Possessive counts and the guards (a match starts after another, not within a run, or at a capital) only save backtracking.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "local_phone": r"(?<![A-Za-z0-9+.@-])(?:\([0-9]{2,5}\)[\x20-]?|0[0-9]{1,4}[\x20/-])[0-9]{2,8}(?:[\x20-][0-9]{2,6}){0,3}(?![A-Za-z0-9@])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "person": rf"(?=[A-Z])(?<![\p{{L}}])(?:(?:{TITLES})\.?\x20\p{{Lu}}\p{{Ll}}{{1,20}}(?:\x20\p{{Lu}}\p{{Ll}}{{1,20}})?|(?:{NAMES})\x20\p{{Lu}}\p{{Ll}}{{1,20}})(?![\p{{L}}])",
}
# What a text must have for the pattern to be tried.
HINTS = {
    "email": r"@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){15}",
    "phone": r"\+[0-9]",
    "local_phone": r"(?:\([0-9]{2}|(?<![0-9A-Za-z])0[0-9]{1,4}[\x20/-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}",
    "person": rf"(?=[A-Z])(?<![\p{{L}}])(?:{TITLES}|{NAMES})\.?\x20\p{{Lu}}\p{{Ll}}",
}
# Strict forms, gazetteers and context words of the labelers.
STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}$",
    "ip": r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$",
    "card": r"^(?:[0-9]{16,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4,7})$",
    "phone": r"^\+[1-9][0-9]{0,2}[\x20.-]?(?:\([0-9]{1,4}\)[\x20.-]?)?[0-9]+(?:[\x20.-][0-9]+)*$",
    "local_phone": r"^(?:\([0-9]{3}\)\x20?|0[0-9]{2,4}[\x20/-])[0-9]{3,8}(?:[\x20-][0-9]{2,6})*$",
    "iban": r"^[A-Z]{2}[0-9]{2}(?:\x20[A-Z0-9]{4}){3,7}(?:\x20[A-Z0-9]{1,3})?$|^[A-Z]{2}[0-9]{13,30}$",
    "person": rf"^(?:(?:{TITLES})\.?\x20)?(?!(?:{TITLES})\b)\p{{Lu}}\p{{Ll}}+\x20\p{{Lu}}\p{{Ll}}+$",
}
GAZETTEER = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|info|io|de|fr|es|eu|uk|us|it|at|ch)$",
    "ip": r"^(?:10|127|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168)\.|^[1-9]",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"^\+(?:1|2[0-9]|3[0-9]|4[0-9]|5[0-9]|6[0-6]|7|8[1246]|9[0-58])",
    "local_phone": r"^\(?0(?:1[2-9]|20|2[0-9]{2,3}|30|3[3-9][0-9]{1,2}|40|4[1-9][0-9]{1,2}|5[1-9][0-9]{1,2}|6[0-9]{1,3}|7[0-9]{1,3}|8[0-9]{1,3}|9[0-9]{1,3}|1[0-9]{3}|[1-5])(?![0-9])",
    "iban": r"^(?:A[DELTZ]|B[AEGHRY]|C[HRYZ]|D[EKO]|E[ES]|F[IOR]|G[BEILRT]|H[RU]|I[ELQST]|JO|K[WZ]|L[BCITUV]|M[CDEKRTU]|N[LO]|P[KLST]|QA|R[OS]|S[ACEIKM]|T[LNR]|UA|VG|XK)",
    "person": rf"(?:^|\x20)(?:{NAMES})(?:\x20(?!(?:{PLACES})$)|$)",
}
CONTEXT = {
    "email": r"mail|contact|kontakt|write|schreib|correo|courriel|address|adresse",
    "ip": r"\bip\b|host|server|address|adresse|login|client|from",
    "card": r"card|karte|carte|tarjeta|visa|credit|kredit|payment|pay",
    "phone": r"tel|phone|call|fax|mobil|handy|anruf|appel|llam|contact|kontakt|whatsapp",
    "local_phone": r"tel|phone|call|fax|mobil|handy|anruf|appel|llam|contact|kontakt|whatsapp",
    "iban": r"iban|account|konto|compte|cuenta|bank",
    "person": r"dear|liebe|cher|querid|from|von|signed|contact|regards|by",
}
LABELERS = ("strict", "gazetteer", "context", "check")
# Kinds whose digits can be checked, and words of context in the order in which they are looked for.
CHECKED = ("ip", "card", "phone", "local_phone", "iban")
CONTEXT_WORDS = tuple(dict.fromkeys(w for c in CONTEXT.values() for w in c.replace(r"\b", "").split("|")))
_SPAN = "array<struct<kind:string,start:int,stop:int,value:string,lead:string,ok:boolean>>"
_LEAD = 32


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of ASCII digits passes the Luhn check; every second digit from the right counts twice."""

    def weight(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), weight), F.lit(0), lambda a, x: a + x) % 10 == 0


def iban_remainder(value: Column) -> Column:
    """An account number's digits modulo 97, the first four characters last and letters as 10 to 35; 1 if it is right."""
    bare = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.left(bare, F.lit(4)))

    def step(a: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (a * 10 + c.try_cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _passes(kind: str, value: Column) -> Column:
    """The check that a match of the pattern must pass to be a span."""
    n = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$")
    if kind == "card":
        return F.when(n.between(16, 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return n.between(8, 15)
    if kind == "local_phone":
        return n.between(7, 13)
    if kind == "iban":
        return iban_remainder(value) == 1
    return F.lit(True)


def _compares(kind: str, value: Column) -> Column:
    """Whether a match that fails its check is like enough to a right one to learn from: a run of digits as long as a card's."""
    return F.length(_digits(value)).between(16, 19) if kind == "card" else F.lit(True)


def spans_of(kind: str, text: Column) -> Column:
    """All matches of a kind in a text, leftmost and non-overlapping, in code points, with the text before them and whether they pass their check (``ok``).

    The pieces between matches and the matches alternate, so places are running
    sums of lengths, which Spark counts in code points.
    """
    pattern = PATTERNS[kind]
    pieces = F.transform(F.split(text, pattern, -1), lambda p: F.struct(F.length(p).alias("n"), F.lower(F.right(p, F.lit(_LEAD))).alias("lead")))
    parts = F.zip_with(pieces, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda p, v: F.struct(p["n"].alias("n"), p["lead"].alias("lead"), v.alias("v")))
    none = F.array().cast(_SPAN)

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + x["n"]
        stop = start + F.coalesce(F.length(x["v"]), F.lit(0))
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), x["v"].alias("value"), x["lead"].alias("lead"), _passes(kind, x["v"]).alias("ok"))
        keep = x["v"].isNotNull() & _compares(kind, x["v"])
        return F.struct(stop.alias("at"), F.when(keep, F.concat(a["out"], F.array(span))).otherwise(a["out"]).cast(_SPAN).alias("out"))

    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda a: a["out"])
    return F.when(text.rlike(HINTS[kind]), found).otherwise(none)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans``, an array of candidates by kind and then start; null texts are as empty.

    A looser candidate that overlaps a base span is left out. A match that fails
    its check is not ``ok``; it is there to learn from alone.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = slim(docs, id_col, text_col).select("doc_id", *(spans_of(k, text).alias(k) for k in KINDS))
    base = F.concat(*(F.col(k) for k in BASE_KINDS))
    loose = F.concat(*(F.col(k) for k in KINDS[len(BASE_KINDS) :]))
    return rows.select("doc_id", base.alias("base"), loose.alias("loose")).select("doc_id", F.concat("base", F.filter("loose", lambda s: ~F.exists("base", lambda b: b["ok"] & (b["start"] < s["stop"]) & (s["start"] < b["stop"])))).alias("spans"))


def _by_kind(kind: Column, make) -> Column:
    out = F.lit(None)
    for k in reversed(KINDS):
        out = F.when(kind == k, make(k)).otherwise(out)
    return out


def votes(span: Column) -> dict[str, Column]:
    """1 yes, 0 no, of each labeler, -1 where a kind has nothing to check. A title in a name is context as the words before it are."""
    kind, value, lead = span["kind"], span["value"], span["lead"]
    titled = (kind == "person") & value.rlike(rf"^(?:{TITLES})\b")
    return {
        "strict": _by_kind(kind, lambda k: value.rlike(STRICT[k]).cast("int")),
        "gazetteer": _by_kind(kind, lambda k: value.rlike(GAZETTEER[k]).cast("int")),
        "context": (titled | _by_kind(kind, lambda k: lead.rlike(CONTEXT[k]))).cast("int"),
        "check": F.when(kind.isin(*CHECKED), span["ok"].cast("int")).otherwise(-1),
    }


def length_bucket(span: Column) -> Column:
    return F.least(F.floor((span["stop"] - span["start"]) / 5), F.lit(7)).cast("int")


def shape(span: Column) -> Column:
    """0 to 15: the share of digits in quarters, and up to three characters that are neither letters nor digits."""
    n = F.greatest(F.length(span["value"]), F.lit(1))
    quarter = F.least(F.floor(F.length(_digits(span["value"])) * 4 / n), F.lit(3))
    others = F.least(F.length(F.regexp_replace(span["value"], r"[\p{L}0-9]", "")), F.lit(3))
    return (quarter * 4 + others).cast("int")


def before(span: Column) -> Column:
    """What stands before: 0 nothing, 1 a colon or equals sign, 2 a letter and a blank, 3 else."""
    lead = span["lead"]
    return F.when(F.trim(lead) == "", 0).when(lead.rlike(r"[:=]\s*$"), 1).when(lead.rlike(r"\p{L}\s$"), 2).otherwise(3)


def context_word(span: Column) -> Column:
    """The first word of context that stands before, by its place in ``CONTEXT_WORDS`` from 1; 0 for none."""
    out = F.lit(0)
    for k, word in reversed(list(enumerate(CONTEXT_WORDS, 1))):
        out = F.when(span["lead"].contains(word), k).otherwise(out)
    return out


Pattern = tuple[str | int, ...]  # kind, the votes, length bucket, shape, what stands before, word of context
FORM = {"length": length_bucket, "shape": shape, "before": before, "word": context_word}
_VOTES = 1 + len(LABELERS)


@dataclass(frozen=True)
class Reliability:
    """Of a labeler: how often it votes yes on personal data and on other candidates."""

    true_yes: float
    false_yes: float


@dataclass(frozen=True)
class SpanModel:
    labelers: dict[str, Reliability]
    prior: dict[str, float]
    coefficients: dict[str, float]
    threshold: float = 0.5


# Before any vote is seen, a labeler is taken to be right in 8 of 10 cases, a check nearly always, with the weight of this many candidates.
PRIOR_WEIGHT = 1.0
START = dict.fromkeys(LABELERS, (0.8, 0.2)) | {"check": (0.99, 0.02)}


def expectation_maximisation(counts: dict[Pattern, int], rounds: int = 30) -> tuple[dict[str, Reliability], dict[str, float], dict[Pattern, float]]:
    """Reliabilities, the share of personal data by kind, and its probability by pattern.

    Only kind and votes matter here. Reliabilities are estimated by kind, under
    ``kind:labeler``, and over all kinds, under the labeler's name. A vote of -1
    is none at all.
    """
    table: dict[tuple, int] = {}
    for p, n in counts.items():
        table[p[:_VOTES]] = table.get(p[:_VOTES], 0) + n
    prior = {k: 0.5 for k in KINDS}
    rel = {f"{k}:{name}": Reliability(*START[name]) for k in KINDS for name in LABELERS}
    posterior: dict[tuple, float] = {}

    def reliability(kinds: tuple[str, ...], j: int) -> Reliability:
        yes, no = (PRIOR_WEIGHT * r for r in START[LABELERS[j]])
        yes_all = no_all = PRIOR_WEIGHT
        for p, n in table.items():
            v = p[1 + j]
            if v >= 0 and p[0] in kinds:
                yes, yes_all = yes + posterior[p] * n * v, yes_all + posterior[p] * n
                no, no_all = no + (1 - posterior[p]) * n * v, no_all + (1 - posterior[p]) * n
        return Reliability(yes / yes_all, no / no_all)

    for _ in range(rounds):
        for p in table:
            z = math.log(prior[p[0]] / (1 - prior[p[0]]))
            for name, v in zip(LABELERS, p[1:_VOTES], strict=True):
                if v >= 0:
                    r = rel[f"{p[0]}:{name}"]
                    z += math.log(r.true_yes / r.false_yes) if v else math.log((1 - r.true_yes) / (1 - r.false_yes))
            posterior[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
        for k in KINDS:
            mine = [(posterior[p], n) for p, n in table.items() if p[0] == k]
            prior[k] = (sum(q * n for q, n in mine) + 1) / (sum(n for _, n in mine) + 2)
        for j, name in enumerate(LABELERS):
            rel |= {f"{k}:{name}": reliability((k,), j) for k in KINDS}
    rel |= {name: reliability(KINDS, j) for j, name in enumerate(LABELERS)}
    return rel, prior, {p: posterior[p[:_VOTES]] for p in counts}


def _features(p: Pattern) -> list[str]:
    """Names of what a pattern has: votes count by kind, forms over all kinds."""
    votes_of_kind = (f"{p[0]}:{n}={v}" for n, v in zip(LABELERS, p[1:_VOTES], strict=True))
    return ["bias", f"kind={p[0]}", *votes_of_kind, *(f"{n}={v}" for n, v in zip(FORM, p[_VOTES:], strict=False))]


def train_classifier(counts: dict[Pattern, int], posterior: dict[Pattern, float], rounds: int = 200, rate: float = 0.5, l2: float = 1e-3) -> dict[str, float]:
    """Logistic regression on the patterns' probabilities, each weighted by the logarithm of its count."""
    weight = {p: math.log1p(n) for p, n in counts.items()}
    total = sum(weight.values()) or 1.0
    w: dict[str, float] = {}
    for _ in range(rounds):
        gradient: dict[str, float] = {}
        for p in sorted(counts):
            f = _features(p)
            q = 1 / (1 + math.exp(-sum(w.get(x, 0.0) for x in f)))
            for x in f:
                gradient[x] = gradient.get(x, 0.0) + weight[p] * (q - posterior[p])
        for x, g in gradient.items():
            w[x] = w.get(x, 0.0) - rate * (g / total + l2 * w.get(x, 0.0)) * 8
    return w


def train_spans(found: DataFrame) -> SpanModel:
    """Trains on the candidates of all documents: their patterns are counted by Spark.

    There are at most 7 kinds * 2**4 votes * 8 lengths * 16 shapes * 4 places * the
    words of context of patterns, whatever the input, and some hundreds in practice;
    that table is all the driver gets.
    """
    one = found.select(F.explode("spans").alias("s"))
    v = votes(F.col("s"))
    keys = [F.col("s.kind").alias("kind"), *(v[n].alias(n) for n in LABELERS), *(f(F.col("s")).alias(n) for n, f in FORM.items())]
    counts = {tuple(r)[:-1]: r.n for r in one.groupBy(*keys).agg(F.count("*").alias("n")).collect()}
    labelers, prior, posterior = expectation_maximisation(counts)
    return SpanModel(labelers, prior, train_classifier(counts, posterior))


def span_probability(span: Column, model: SpanModel) -> Column:
    w = model.coefficients
    v = votes(span)
    z = F.lit(w.get("bias", 0.0)) + _by_kind(span["kind"], lambda k: F.lit(w.get(f"kind={k}", 0.0)))

    def weight_of(name: str, column: Column) -> Column:
        term = F.lit(0.0)
        for x, c in w.items():
            if x.startswith(f"{name}="):
                term = F.when(column == int(x.split("=")[1]), c).otherwise(term)
        return term

    for name, column in v.items():
        z = z + _by_kind(span["kind"], lambda k, name=name, column=column: weight_of(f"{k}:{name}", column))
    for name, form in FORM.items():
        z = z + weight_of(name, form(span))
    return 1 / (1 + F.exp(-z))


def accepted(found: DataFrame, model: SpanModel) -> DataFrame:
    """``doc_id, base, spans``: base spans, and all that are kept, each by kind and then start."""
    base = F.filter("spans", lambda s: s["ok"] & s["kind"].isin(*BASE_KINDS))
    kept = F.filter("spans", lambda s: s["ok"] & (s["kind"].isin(*BASE_KINDS) | (span_probability(s, model) >= model.threshold)))
    return found.select("doc_id", base.alias("base"), kept.alias("spans"))


def as_text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, spans`` for every row, the span model trained on the same documents' candidates."""
    found = written(candidates(docs, id_col, text_col), "candidates")
    return accepted(found, train_spans(found))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every document."""
    found = find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in BASE_KINDS), F.sha2(as_text("base"), 256).alias("base_sha256"), as_text("spans").alias("spans"))

"""Review rules (X05-X10, X19-X24) and review list operations (D05, D06,
T04, T05) as Spark expressions: array higher-order functions, joins and
aggregates.  No Python runs per row here."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.text import computed_once, duplicate_key, normalize_py, tokenize

# Default lexicons, negators, breakers and themes of the rules.
POSITIVE = ("excellent parfait parfaite super satisfait satisfaite recommande rapide genial impeccable adore "
            "amazing great perfect love satisfied recommend bom boa otimo otima excelente perfeito perfeita "
            "recomendo satisfeito satisfeita gostei rapido rapida").split()
NEGATIVE = ("mauvais mauvaise horrible nul nulle casse cassee defectueux defectueuse decevant decu decue retard "
            "lent lente arnaque bad broken terrible disappointed awful defective late ruim pessimo pessima "
            "quebrado quebrada defeito defeituoso decepcionado atrasado atrasada atraso lento lenta").split()
NEGATORS = ["pas", "non", "not", "no", "never", "nao", "jamais"]
BREAKERS = [".", "!", "?", ",", ";", ":", "mais", "but", "mas"]
THEMES = {
    "Livraison": ("livraison livre livraison livreur transport colis retard delivery shipping delivered package "
                  "late entrega entregue frete transportadora atraso atrasado correios").split(),
    "Produit / qualité": ("produit qualite casse defectueux taille couleur product quality broken size color "
                          "produto qualidade quebrado defeito tamanho cor").split(),
    "Prix / paiement": ("prix cher chere tarif paiement remboursement price expensive payment refund preco caro "
                        "cara pagamento reembolso valor").split(),
    "Service client": "sav assistance service support vendeur seller atendimento vendedor contato resposta".split(),
    "Emballage": "emballage emballe packaging packed embalagem embalado caixa".split(),
}
SENTIMENTS = ["Positif", "Négatif", "Neutre", "Mixte", "Indéterminé", "Sans texte"]
POS, NEG, NEU, MIXED, UNDETERMINED, NO_TEXT = SENTIMENTS[0], SENTIMENTS[1], SENTIMENTS[2], SENTIMENTS[3], \
    SENTIMENTS[4], SENTIMENTS[5]
NO_THEME = "Sans thème détecté"
RULES_METHOD = "Règles lexicales FR / PT / EN ; à vérifier"
LOOK_BACK = 3


@dataclass(frozen=True)
class Lexicon:
    positive: Sequence[str] = tuple(POSITIVE)
    negative: Sequence[str] = tuple(NEGATIVE)
    negators: Sequence[str] = tuple(NEGATORS)
    breakers: Sequence[str] = tuple(BREAKERS)
    themes: dict = field(default_factory=lambda: dict(THEMES))


def _arr(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def polarities(tokens: Column, lx: Lexicon = Lexicon()) -> Column:
    """+1 / -1 of each polarity word in text order, flipped when a negator occurs in
    the previous three tokens before any breaker.

    ``tokens`` must be a column, not an expression: the look-back reads it at three
    places a polarity word."""
    places = F.filter(F.transform(tokens, lambda t, i: F.when(t.isin(*lx.positive, *lx.negative), i)), lambda i: i.isNotNull())

    def one(i):
        negated = F.lit(False)
        for k in range(LOOK_BACK, 0, -1):          # built inside out: nearest token is tested first
            w = F.get(tokens, i - k)
            stop = w.isNull() | w.isin(*lx.breakers)
            negated = F.when(stop, F.lit(False)).otherwise(w.isin(*lx.negators) | negated)
        base = F.when(F.get(tokens, i).isin(*lx.positive), 1).otherwise(-1)
        return F.when(negated, -base).otherwise(base)
    return F.transform(places, one)


def _counts(p: Column) -> Column:
    init = F.struct(F.lit(0).alias("np"), F.lit(0).alias("nn"))
    return F.aggregate(p, init, lambda acc, x: F.struct((acc["np"] + F.when(x > 0, 1).otherwise(0)).alias("np"),
                                                         (acc["nn"] + F.when(x < 0, 1).otherwise(0)).alias("nn")))


def lexicon_sentiment(signs: Column, blank: Column) -> Column:
    """X05 on ``polarities``: Mixte / Positif / Négatif / Indéterminé; blank text -> Sans texte."""
    c = _counts(signs)
    code = F.when(blank, 4).otherwise(F.signum(c["np"]).cast("int") * 2 + F.signum(c["nn"]).cast("int"))
    labels = F.array(F.lit(UNDETERMINED), F.lit(NEG), F.lit(POS), F.lit(MIXED), F.lit(NO_TEXT))
    return F.element_at(labels, code + 1)


def themes_by_token(tokens: Column, themes: dict | None = None) -> Column:
    """A theme when its word set meets the token set (theme order kept)."""
    themes = THEMES if themes is None else themes
    hits = [F.when(F.arrays_overlap(tokens, _arr(words)), F.lit(name)) for name, words in themes.items()]
    return F.filter(F.array(*hits), lambda x: x.isNotNull()) if hits else F.array().cast("array<string>")


def with_rules(df: DataFrame, blank: Column, lx: Lexicon = Lexicon(), themes: Column | None = None) -> DataFrame:
    """X04-X07 on a ``normalized`` column: adds tokens, sentiment, themes and evidence.  The text is cut into tokens
    once and compared once with all words of the rules; the rules read what was found
    (evidence, X06: polarity words in order of first appearance).  ``themes`` replaces X07."""
    polar = [*lx.positive, *lx.negative]
    named = [w for words in lx.themes.values() for w in words]
    found, signs = F.col("_found"), F.col("_signs")
    out = (df.withColumn("tokens", computed_once(tokenize("normalized")))
           .withColumn("_found", computed_once(F.array_intersect("tokens", _arr(list(dict.fromkeys(polar + named))))))
           .withColumn("_signs", computed_once(F.when(F.arrays_overlap(found, _arr(polar)), polarities(F.col("tokens"), lx))
                                               .otherwise(F.array().cast("array<int>")))))
    return (out.withColumn("sentiment", lexicon_sentiment(signs, blank))
            .withColumn("themes", themes_by_token(found, lx.themes) if themes is None else themes)
            .withColumn("evidence", F.array_intersect(found, _arr(polar))).drop("_found", "_signs"))


def phrase_pattern(terms: Sequence[str]) -> str | None:
    """Whole-word alternation of normalized, quoted terms (Unicode word bounds)."""
    cleaned = [normalize_py(t).strip() for t in terms if t.strip()]
    if not cleaned:
        return None
    return r"(?U)(?<!\w)(?:" + "|".join(r"\Q" + t.replace(r"\E", r"\E\\E\Q") + r"\E" for t in cleaned) + r")(?!\w)"


def themes_by_phrase(normalized: Column, rules: dict) -> Column:
    """Custom themes: a theme when any of its phrases occurs as whole words."""
    hits = []
    for name, terms in rules.items():
        pat = phrase_pattern(terms)
        if pat is not None:
            hits.append(F.when(normalized.rlike(pat), F.lit(name)))
    return F.filter(F.array(*hits), lambda x: x.isNotNull()) if hits else F.array().cast("array<string>")


# Largest set of repeated keys that is broadcast to the rows (32-byte
# hashes: about 60 MB at this bound); beyond it the flags use a shuffle join.
BROADCAST_REPEATED_KEYS = 1_000_000


def duplicate_hash(normalized: Column) -> Column:
    """The 32 bytes of the SHA-256 of the X09 key; null for an empty key (never a duplicate)."""
    key = duplicate_key(normalized)
    return F.when(key != "", F.unhex(F.sha2(key, 256)))


def flag_duplicates(df: DataFrame, normalized: str = "normalized", out: str = "duplicate",
                    hash_col: str | None = None) -> DataFrame:
    """Rows whose duplicate key is non-empty and shared by another row
    (over all rows).  Keys are hashed and counted with a map-side combined
    aggregate; no ungrouped window.  The set of repeated hashes is counted
    first (bounded check): when it holds at most BROADCAST_REPEATED_KEYS it is
    broadcast, so the annotated rows are never shuffled; otherwise the flags
    come from a shuffle join (AQE splits a skewed key).  ``hash_col`` names a
    precomputed ``duplicate_hash`` column (e.g. in a written table, so the
    count reads one narrow column)."""
    from mercato.operators.ranks import is_small
    from mercato.session import checkpoint_dir
    if hash_col is None:
        df = df.withColumn("_dh", duplicate_hash(F.col(normalized)))
        hash_col = "_dh"
    repeated = (df.select(hash_col).filter(F.col(hash_col).isNotNull()).groupBy(hash_col)
                .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
                .select(hash_col, F.lit(True).alias("_rep")))
    checkpoint_dir(df.sparkSession)
    repeated = repeated.checkpoint(eager=True)     # computed once; no session cache entry
    if is_small(repeated, BROADCAST_REPEATED_KEYS):
        repeated = F.broadcast(repeated)
    return (df.join(repeated, hash_col, "left")
            .withColumn(out, F.coalesce(F.col("_rep"), F.lit(False))).drop(hash_col, "_rep"))


def rating_conflict(rating: Column, sentiment: Column, scale: int = 5) -> Column:
    """Low rating with a positive text or high rating with a negative
    text.  Scale 5 means 1..5, 10 means 0..10; null or out of range -> false."""
    lo = 1 if scale == 5 else 0
    v = (rating - lo) / F.lit(float(scale - lo))
    ok = rating.isNotNull() & (rating >= lo) & (rating <= scale)
    return F.coalesce(ok & (((v <= 0.25) & (sentiment == POS)) | ((v >= 0.75) & (sentiment == NEG))), F.lit(False))


def apply_corrections(rows: DataFrame, corrections: DataFrame, key: str = "row_id") -> DataFrame:
    """A manual label replaces the sentiment; the initial one is kept,
    corrected = true and uncertain = false on corrected rows."""
    c = corrections.select(F.col(key), F.col("sentiment").alias("_manual"))
    j = rows.join(c, key, "left")
    fixed = F.col("_manual").isNotNull()
    return (j.withColumn("sentiment_initial", F.coalesce(F.col("sentiment_initial"), F.col("sentiment"))
                         if "sentiment_initial" in rows.columns else F.col("sentiment"))
            .withColumn("sentiment", F.coalesce(F.col("_manual"), F.col("sentiment")))
            .withColumn("corrected", fixed | F.coalesce(F.col("corrected"), F.lit(False)))
            .withColumn("uncertain", F.when(fixed, F.lit(False)).otherwise(F.col("uncertain")))
            .drop("_manual"))


def sentiment_summary(rows: DataFrame) -> DataFrame:
    """Count and share of the selected rows for the six classes; classes
    with no row are kept with 0; an empty selection gives shares of 0."""
    spark = rows.sparkSession
    classes = spark.createDataFrame([(s, i) for i, s in enumerate(SENTIMENTS)], "sentiment string, position int")
    counts = rows.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("_total"))
    return (F.broadcast(classes).join(counts, "sentiment", "left").crossJoin(total)
            .select("sentiment", "position", F.coalesce("n", F.lit(0)).alias("n"),
                    F.coalesce(F.try_divide(F.coalesce("n", F.lit(0)) * 100.0, F.col("_total")), F.lit(0.0))
                    .alias("share_pct")))


def theme_summary(rows: DataFrame, theme_names: Sequence[str]) -> DataFrame:
    """Count and share per theme; a row may count in several themes or none."""
    spark = rows.sparkSession
    names = spark.createDataFrame([(t, i) for i, t in enumerate(theme_names)], "theme string, position int")
    counts = rows.select(F.explode("themes").alias("theme")).groupBy("theme").agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("_total"))
    return (F.broadcast(names).join(counts, "theme", "left").crossJoin(total)
            .select("theme", "position", F.coalesce("n", F.lit(0)).alias("n"),
                    F.coalesce(F.try_divide(F.coalesce("n", F.lit(0)) * 100.0, F.col("_total")), F.lit(0.0))
                    .alias("share_pct")))


def review_kpis(rows: DataFrame) -> DataFrame:
    """Total, negatives, no text, mean of non-null ratings, to verify."""
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("sentiment") == NEG).alias("negatives"),
                    F.count_if(F.col("sentiment") == NO_TEXT).alias("no_text"),
                    F.avg("rating").alias("mean_rating"), F.count_if(F.col("uncertain")).alias("to_verify"))


def evaluate_labels(rows: DataFrame, expected: str = "expected", by: str = "language") -> DataFrame:
    """Per group: total, correct, abstentions (undetermined)."""
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("total"),
                                F.count_if(F.col("sentiment") == F.col(expected)).alias("correct"),
                                F.count_if(F.col("sentiment") == UNDETERMINED).alias("abstentions"))


# Column codes of the confusion matrix, in class order.
CLASS_CODES = ["positive", "negative", "neutral", "mixed", "undetermined", "no_text"]


def confusion_matrix(rows: DataFrame, expected: str = "expected") -> DataFrame:
    """Expected label x predicted class counts (pivot over the six
    classes, so the schema does not depend on the data)."""
    code = F.element_at(F.create_map(*[x for pair in zip(SENTIMENTS, CLASS_CODES) for x in map(F.lit, pair)]),
                        F.col("sentiment"))
    return rows.withColumn("_code", code).groupBy(expected).pivot("_code", CLASS_CODES).agg(
        F.count(F.lit(1))).na.fill(0, CLASS_CODES)


def reject_oversize(df: DataFrame, text: str = "text", limit: int = 100_000,
                    raise_error: bool = False) -> tuple[DataFrame, DataFrame]:
    """Texts over ``limit`` characters are refused (reject table, or a
    job error with ``raise_error``)."""
    too_long = F.length(F.col(text)) > limit
    if raise_error:
        fail = F.raise_error(F.lit(f"a text exceeds {limit} characters"))
        checked = df.filter(F.coalesce(F.when(too_long, fail).cast("boolean"), F.lit(True)))
        return checked, df.limit(0)
    return df.filter(~too_long | F.col(text).isNull()), df.filter(too_long)


@dataclass
class ReviewFilter:
    """Combined AND of the review list filters (None = not set)."""
    search: str | None = None
    sentiment: str | None = None
    theme: str | None = None
    rating_min: float | None = None
    rating_max: float | None = None
    duplicates: bool = False
    uncertain: bool = False
    corrected: bool = False
    conflict: bool = False
    scale: int = 5
    language: str | None = None
    rating: float | None = None

    def predicate(self) -> Column:
        cond = F.lit(True)
        if self.search:
            cond &= F.col("normalized").contains(normalize_py(self.search))
        if self.sentiment:
            cond &= F.col("sentiment") == self.sentiment
        if self.theme:
            cond &= (F.size("themes") == 0) if self.theme == NO_THEME else F.array_contains("themes", self.theme)
        if self.rating_min is not None:
            cond &= F.col("rating").isNotNull() & (F.col("rating") >= self.rating_min)
        if self.rating_max is not None:
            cond &= F.col("rating").isNotNull() & (F.col("rating") <= self.rating_max)
        if self.duplicates:
            cond &= F.col("duplicate")
        if self.uncertain:
            cond &= F.col("uncertain")
        if self.corrected:
            cond &= F.col("corrected")
        if self.conflict:
            cond &= rating_conflict(F.col("rating"), F.col("sentiment"), self.scale)
        if self.language:
            cond &= F.col("language") == self.language
        if self.rating is not None:
            cond &= F.col("rating") == self.rating
        return cond


def review_filter(rows: DataFrame, flt: ReviewFilter) -> DataFrame:
    return rows.filter(flt.predicate())


def sort_reviews(rows: DataFrame, mode: str = "original", seq: str = "row_id") -> DataFrame:
    """Source order, longest text, lowest or highest rating (nulls
    last); ties keep source order."""
    if mode == "original":
        keys = [F.col(seq).asc()]
    elif mode == "long":
        keys = [F.length("text").desc(), F.col(seq).asc()]
    elif mode == "low":
        keys = [F.col("rating").asc_nulls_last(), F.col(seq).asc()]
    elif mode == "high":
        keys = [F.col("rating").desc_nulls_last(), F.col(seq).asc()]
    else:
        raise ValueError(mode)
    return rows.orderBy(*keys)


def page(rows: DataFrame, k: int, size: int = 50, mode: str = "original", seq: str = "row_id") -> DataFrame:
    """Page k (0-based) of ``size`` rows after the sort."""
    return sort_reviews(rows, mode, seq).offset(k * size).limit(size)

"""TF-IDF features: long (relational) form and ML vector form.

Both forms share one vocabulary rule, computed relationally:

* document and corpus frequency per term are summed up in the tasks that cut
  the texts (``functions.grams``), then by term, and written once: a hot term
  costs a few rows per map task, and every later step reads one row per term;
* on a large corpus of words a first tokenisation counts terms in a fixed number of
  hashed places, whose totals rule out the terms that can't reach the cut, so
  only candidates are shuffled by the second one (``candidate_places``);
* ``min_df``/``max_df`` filter, then the ``max_features`` most frequent terms
  (ties: term ascending) - a top-k, not a sort;
* idf = ln((1 + n) / (1 + df)) + 1; rows are L2-normalised.

The vector form turns the vocabulary into a ``CountVectorizerModel`` (the
vocabulary list is what Spark ML itself keeps on the driver; its size is capped
by ``max_features``) followed by ``ElementwiseProduct`` with the idf and
``Normalizer(p=2)``: standard, persistable stages that score batches and
streams alike.  The long form of a bounded vocabulary is weighed in the same
tasks: no shuffle.  Without a bound, blocks of rows exchange their distinct
terms for document frequencies (``functions.termsets``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.ml.wrapper import JavaParams
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polarity.functions import grams, termsets
from polarity.functions.text import check_range, preprocess_for_terms, with_term_counts, with_terms, word_tokens
from polarity.session import materialize, source_bytes, spread


@dataclass(frozen=True)
class TfidfConfig:
    """One vectoriser (J6): analyzer, n-gram range and vocabulary limits."""

    analyzer: str = "word"
    ngram_range: tuple[int, int] = (1, 1)
    min_df: float = 1
    max_df: float = 1.0
    max_features: int | None = None
    lowercase: bool = True
    strip_accents: str | None = None

    def __post_init__(self):
        rng = self.ngram_range
        if not isinstance(rng, (list, tuple)) or len(rng) != 2:
            raise ValueError("ngram_range takes two numbers")
        object.__setattr__(self, "ngram_range", (int(rng[0]), int(rng[1])))
        if self.analyzer not in ("word", "char_wb"):
            raise ValueError(f"Unknown analyzer: {self.analyzer}")

    @classmethod
    def from_dict(cls, cfg: dict) -> "TfidfConfig":
        keys = {"analyzer", "ngram_range", "min_df", "max_df", "max_features", "lowercase", "strip_accents"}
        return cls(**{k: v for k, v in cfg.items() if k in keys})


@dataclass(frozen=True)
class FeatureSpec:
    """``word`` (one vectoriser) or ``word_char_hybrid`` (word + char_wb)."""

    feature_type: str = "word"
    parts: tuple[TfidfConfig, ...] = field(default_factory=lambda: (TfidfConfig(),))

    @classmethod
    def from_dict(cls, cfg: dict) -> "FeatureSpec":
        kind = cfg.get("feature_type", "word")
        if kind == "word":
            return cls("word", (TfidfConfig.from_dict(cfg),))
        if kind == "word_char_hybrid":
            if "word" not in cfg or "char" not in cfg:
                raise ValueError("a word_char_hybrid needs a word part and a char part")
            char = dict(cfg["char"])
            char.setdefault("analyzer", "char_wb")
            return cls(kind, (TfidfConfig.from_dict(cfg["word"]), TfidfConfig.from_dict(char)))
        raise ValueError(f"no such feature_type: {kind}")


# The three feature variants and the baseline vectoriser of the
# reference configuration.
BASELINE_TFIDF = TfidfConfig(ngram_range=(1, 2), min_df=2, max_df=0.95, max_features=50000,
                             strip_accents="unicode")
VARIANTS = {
    "basic_unigram": FeatureSpec("word", (TfidfConfig(ngram_range=(1, 1), min_df=2, max_df=0.95,
                                                      max_features=30000, strip_accents="unicode"),)),
    "unigram_bigram": FeatureSpec("word", (BASELINE_TFIDF,)),
    "real_word_char_hybrid": FeatureSpec("word_char_hybrid", (
        BASELINE_TFIDF,
        TfidfConfig(analyzer="char_wb", ngram_range=(3, 5), min_df=2, max_df=0.95, max_features=30000))),
}


# --- long form -----------------------------------------------------------------

def add_terms(df: DataFrame, cfg: TfidfConfig, text_col: str, out_col: str) -> DataFrame:
    return with_terms(df, text_col, out_col, cfg.analyzer, cfg.ngram_range, cfg.lowercase, cfg.strip_accents)


def doc_terms(df: DataFrame, cfg: TfidfConfig, text_col: str = "clean_text",
              id_col: str = "row_id") -> DataFrame:
    """(row_id, term, tf): counted in the row; n-grams of 3 characters on as integer keys in the tasks."""
    if cfg.analyzer == "char_wb" and check_range(cfg.ngram_range)[0] == 3:
        texts = _as_read(spread(df.select(id_col, text_col), id_col), cfg, text_col, id_col)
        schema = T.StructType([df.schema[id_col], *T.StructType.fromDDL("term string, tf long")])
        return texts.mapInArrow(grams.listing(*check_range(cfg.ngram_range), schema.names), schema)
    terms = add_terms(spread(df.select(id_col, text_col), id_col), cfg, text_col, "_terms")
    # explode_outer: a plain explode makes the optimizer infer "size(array) > 0"
    # and push it below the projections, re-running the counting inside it
    counted = with_term_counts(terms, "_terms", "_counts").select(id_col, F.explode_outer("_counts").alias("_e"))
    return (counted.select(id_col, F.col("_e.term").alias("term"), F.col("_e.tf").alias("tf"))
                   .where(F.col("term").isNotNull()))


def document_frequency(terms: DataFrame) -> DataFrame:
    """(term, df, tf_total) of (row, term, tf) with partial aggregation on the term."""
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf_total"))


def _occurrences(df: DataFrame, cfg: TfidfConfig, text_col: str, id_col: str) -> DataFrame:
    """(row, which, term): every distinct term of a row once (which = 0), every
    occurrence (1), and one row without a term (2), which counts the rows.

    Plain explodes of arrays: no lambda, no sort, nothing shuffled."""
    terms = add_terms(spread(df.select(id_col, text_col), id_col), cfg, text_col, "_terms")
    lists = F.array(F.array_distinct("_terms"), F.col("_terms"), F.array(F.lit(None).cast("string")))
    # outer explodes: for plain ones the optimizer infers "size(array) > 0" and
    # pushes it below the projections, which runs the tokeniser again
    rows = (terms.select(F.col(id_col).alias("_id"), F.posexplode_outer(lists).alias("which", "_list"))
            .select("_id", "which", F.explode_outer("_list").alias("term")))
    return rows.filter((F.col("which") == 2) | F.col("term").isNotNull())


def _counted(occurrences: DataFrame, *keys) -> DataFrame:
    return occurrences.groupBy(*keys).agg(F.count_if(F.col("which") == 0).alias("df"), F.count_if(F.col("which") == 1).alias("tf_total"),
                                          F.count_if(F.col("which") == 2).alias("docs"))


PLACES = 1 << 20            # hashed places of the first pass
SAMPLE = 16                 # one row in so many gives lower bounds of the counts
PRUNE_BYTES = 8 << 30       # from this much input on, a first pass rules out terms


def _place(term) -> F.Column:
    return F.pmod(F.xxhash64(term), F.lit(PLACES)).cast("int")


def candidate_places(occurrences: DataFrame, cfg: TfidfConfig) -> tuple[DataFrame, int]:
    """(places whose terms may enter the vocabulary, number of documents).

    A place's total is an upper bound for each of its terms.  Rows of a fixed
    sixteenth also count by term: their counts are lower bounds, so the
    ``max_features``-th largest of those that surely pass ``min_df`` and
    ``max_df`` is a bound that the true cut reaches.  A place below it, or below
    ``min_df``, holds no term of the vocabulary.  A map task ships at most one
    row per place besides its share of the sample.
    """
    named = F.when(F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(SAMPLE)) == 0, F.col("term"))
    both = materialize(_counted(occurrences.select("which", _place("term").alias("place"), named.alias("named"),
                                                   F.col("term").isNull().alias("doc")), "place", "named", "doc"))
    n_docs = both.filter("doc").agg(F.sum("docs")).first()[0] or 0
    lo, hi = _df_limits(cfg, n_docs)
    totals = both.filter("not doc").groupBy("place").agg(F.sum("df").alias("df_most"), F.sum("tf_total").alias("tf_most"))
    least = 0
    if cfg.max_features is not None:
        sure = (both.filter("named is not null").join(F.broadcast(totals), "place")     # PLACES rows at most
                .filter((F.col("df") >= F.lit(lo)) & (F.col("df_most") <= F.lit(hi))).select("named", "tf_total"))
        least = _value_at(sure, int(cfg.max_features)) or 0
    kept = totals.filter((F.col("df_most") >= F.lit(lo)) & (F.col("tf_most") >= F.lit(least)))
    return materialize(kept.select("place")), n_docs


def _as_read(df: DataFrame, cfg: TfidfConfig, text_col: str, *keep: str) -> DataFrame:
    """(keep, _text): what ``functions.grams`` cuts, the preprocessed text or its tokens joined by blanks."""
    text = preprocess_for_terms(text_col, cfg.lowercase, cfg.strip_accents)
    return df.select(*keep, (F.array_join(word_tokens(text), " ") if cfg.analyzer == "word" else F.make_valid_utf8(text)).alias("_text"))


def term_counts(fit_df: DataFrame, cfg: TfidfConfig, text_col: str = "clean_text", id_col: str = "row_id",
                pruned: bool | None = None) -> tuple[DataFrame, int]:
    """Written (term, df, tf_total) and the number of documents.

    One tokenisation, summed up in the tasks; two when ``pruned`` (None: by the
    size of the input, for words), and then of the terms that may enter the
    vocabulary only.  Counts are exact in either case."""
    if pruned if pruned is not None else cfg.analyzer == "word" and source_bytes(fit_df) >= PRUNE_BYTES:
        occurrences = _occurrences(fit_df, cfg, text_col, id_col)
        places, n_docs = candidate_places(occurrences, cfg)
        terms = occurrences.filter("term is not null").withColumn("place", _place("term"))
        terms = terms.join(F.broadcast(places), "place", "left_semi")                   # PLACES rows at most
        return materialize(_counted(terms, "term").drop("docs")), n_docs
    texts = _as_read(spread(fit_df.select(id_col, text_col), id_col), cfg, text_col)
    sums = texts.mapInArrow(grams.counting(cfg.analyzer, *check_range(cfg.ngram_range)), grams.COUNTS)
    counts = materialize(sums.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("df", "tf_total", "docs")]))
    n_docs = counts.filter("term is null").agg(F.sum("docs")).first()[0] or 0
    return counts.filter("term is not null").drop("docs"), n_docs


def fit_vocabulary(fit_df: DataFrame, cfg: TfidfConfig, text_col: str = "clean_text",
                   id_col: str = "row_id", pruned: bool | None = None) -> tuple[DataFrame, int]:
    """Fit J4 on ``fit_df``: (vocabulary frame, number of documents)."""
    missing = [c for c in (text_col, id_col) if c not in fit_df.columns]
    if missing:
        raise ValueError(f"a vocabulary can't be fitted without column(s) {missing}")
    counts, n_docs = term_counts(fit_df, cfg, text_col, id_col, pruned)
    return vocabulary(counts, n_docs, cfg), n_docs


def _df_limits(cfg: TfidfConfig, n_docs: int) -> tuple[float, float]:
    """Integer limits are document counts, float limits fractions of ``n_docs``."""
    lo = cfg.min_df if isinstance(cfg.min_df, int) else math.ceil(float(cfg.min_df) * n_docs)
    hi = cfg.max_df if isinstance(cfg.max_df, int) else float(cfg.max_df) * n_docs
    return lo, hi


def vocabulary(dfreq: DataFrame, n_docs: int, cfg: TfidfConfig) -> DataFrame:
    """min_df / max_df filter, then the top ``max_features`` by corpus tf.

    Output: (term, df, tf_total, idf).
    """
    lo, hi = _df_limits(cfg, n_docs)
    kept = dfreq.where((F.col("df") >= F.lit(lo)) & (F.col("df") <= F.lit(hi)))
    if cfg.max_features is not None:
        kept = _most_frequent(kept, int(cfg.max_features))
    n = F.lit(float(n_docs))
    idf = F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return kept.select("term", "df", "tf_total", idf.alias("idf"))


def _cut_at(terms: DataFrame, k: int) -> tuple[int, int] | None:
    """(tf_total of the ``k``-th largest row, rows above that value), or None
    when there are fewer rows.

    Rows are counted in bands of like ``tf_total`` (some hundreds), then by
    value inside the band that holds the cut; no sort of the rows."""
    band = F.floor(F.log2("tf_total") * 16)
    bands = sorted(((r[0], r[1]) for r in terms.groupBy(band).agg(F.count(F.lit(1))).collect()), reverse=True)
    before = 0
    for at, n in bands:
        if before + n >= k:
            break
        before += n
    else:
        return None
    above = Window.orderBy(F.col("tf_total").desc()).rowsBetween(Window.unboundedPreceding, -1)
    steps = (terms.filter(band == at).groupBy("tf_total").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("before", F.coalesce(F.sum("n").over(above), F.lit(0)) + F.lit(before)))
    row = steps.filter((F.col("before") < k) & (F.col("before") + F.col("n") >= k)).first()
    return row.tf_total, row.before


def _value_at(terms: DataFrame, k: int) -> int | None:
    cut = _cut_at(terms, k)
    return cut and cut[0]


def _most_frequent(terms: DataFrame, k: int) -> DataFrame:
    """The ``k`` rows of largest ``tf_total`` (ties: first term).

    Terms above the value at the cut stay without any sort, and only those that
    tie with it are put in order."""
    cut = _cut_at(terms, k)
    if cut is None:
        return terms
    ties = terms.filter(F.col("tf_total") == F.lit(cut[0])).orderBy("term").limit(k - cut[1])
    return terms.filter(F.col("tf_total") > F.lit(cut[0])).unionByName(ties)


HEAVY = 1 << 16             # kept for callers: no term needs a way of its own
BLOCK_BYTES = 8 << 20       # text of a block when the vocabulary has no bound


def tfidf_long(df: DataFrame, cfg: TfidfConfig, text_col: str = "clean_text", id_col: str = "row_id",
               fit_df: DataFrame | None = None, heavy: int = HEAVY, digits: int | None = None) -> DataFrame:
    """J5 long form: (row_id, term, tfidf), vocabulary fitted on ``fit_df``.
    With ``digits`` the weights are rounded to them.

    The texts are tokenised twice: for the vocabulary, and for the weights.  A
    vocabulary of at most ``max_features`` terms weighs every row where it is
    read.  Without that bound the rows are dealt out in blocks, which are weighed
    with the frequencies sent back to them (``functions.termsets``): a block
    sends a distinct term once, however many rows hold it, so frequent terms are
    not set apart any more and ``heavy`` changes nothing.
    """
    if cfg.max_features is None:
        return _weighed_in_blocks(df, cfg, text_col, id_col, fit_df, digits)
    counts, n_docs = term_counts(df if fit_df is None else fit_df, cfg, text_col, id_col)
    terms, idf = _as_lists(vocabulary(counts, n_docs, cfg))
    if not terms:
        return df.select(id_col, F.lit("").alias("term"), F.lit(0.0).alias("tfidf")).limit(0)
    texts = _as_read(spread(df.select(id_col, text_col), id_col), cfg, text_col, id_col)
    schema = T.StructType([df.schema[id_col], *T.StructType.fromDDL("term string, tfidf double")])
    out = texts.mapInArrow(grams.weighing(cfg.analyzer, *cfg.ngram_range, terms, idf, schema.names), schema)
    return out if digits is None else out.withColumn("tfidf", F.round("tfidf", digits))


def _weighed_in_blocks(df: DataFrame, cfg: TfidfConfig, text_col: str, id_col: str, fit_df: DataFrame | None, digits: int | None) -> DataFrame:
    cut, cores = (cfg.analyzer, *check_range(cfg.ngram_range)), df.sparkSession.sparkContext.defaultParallelism

    def blocks(source: DataFrame, size: int) -> tuple[DataFrame, int]:
        n = max(cores * 2, -(-size // BLOCK_BYTES))
        names = F.split(F.lit(",".join(map(str, termsets.spark_places(n)))), ",").cast("array<int>")
        block = F.element_at(names, (F.pmod(F.xxhash64(id_col), F.lit(n)) + 1).cast("int")).alias("_block")
        return _as_read(source.select(id_col, text_col, block).repartition(n, "_block"), cfg, text_col, id_col, "_block"), n

    def measured(source: DataFrame) -> tuple[int, int]:
        row = source.agg(F.count(F.lit(1)), F.sum(F.octet_length(text_col))).first()
        return row[0], row[1] or 0

    n_docs, size = measured(df)
    rows, n = blocks(df, size)
    buckets = max(cores * 2, n // 2)                # fewer buckets, fewer words sent more than once
    places = termsets.spark_places(buckets)
    if fit_df is None:
        asked = rows.mapInArrow(termsets.asking(*cut, places, termsets.COUNTS | termsets.ASKS), termsets.ASKED)
    else:
        n_docs, size = measured(fit_df)
        asked = (rows.mapInArrow(termsets.asking(*cut, places, termsets.ASKS), termsets.ASKED)
                 .unionByName(blocks(fit_df, size)[0].mapInArrow(termsets.asking(*cut, places, termsets.COUNTS), termsets.ASKED)))
    answers = asked.repartition(buckets, "_place").mapInArrow(termsets.answering, termsets.ANSWERED)
    schema = T.StructType([df.schema[id_col], *T.StructType.fromDDL("term string, tfidf double")])
    weigh = termsets.weighed(*cut, buckets, _df_limits(cfg, n_docs), n_docs, schema.names, digits)
    # both sides lie by block; the rows' side is the exchange that the first cut reads, too
    return rows.groupBy("_block").cogroup(answers.repartition(n, "_block").groupBy("_block")).applyInArrow(weigh, schema)


def count_vectorizer(terms: list[str], input_col: str, output_col: str) -> CountVectorizerModel:
    """``CountVectorizerModel.from_vocabulary`` without a gateway call per term.

    No term holds a line break: terms are made of what stands between
    whitespace, joined by blanks."""
    jvm = SparkSession.active().sparkContext._jvm
    names = jvm.java.util.regex.Pattern.compile("\n").split("\n".join(terms))
    model = CountVectorizerModel(JavaParams._new_java_obj("org.apache.spark.ml.feature.CountVectorizerModel", names))
    return model.setInputCol(input_col).setOutputCol(output_col)


def _as_lists(vocab: DataFrame) -> tuple[list[str], list[float]]:
    rows = vocab.orderBy(F.col("tf_total").desc(), F.col("term").asc()).select("term", "idf").collect()
    return [r[0] for r in rows], [float(r[1]) for r in rows]


# --- vector form (Spark ML stages) -------------------------------------------------

class TextTerms(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Analyzer stage: text -> array<string> of terms (word or char_wb n-grams)."""

    analyzer = Param(Params._dummy(), "analyzer", "word or char_wb", typeConverter=TypeConverters.toString)
    ngramMin = Param(Params._dummy(), "ngramMin", "smallest n", typeConverter=TypeConverters.toInt)
    ngramMax = Param(Params._dummy(), "ngramMax", "largest n", typeConverter=TypeConverters.toInt)
    lowercase = Param(Params._dummy(), "lowercase", "lower-case first", typeConverter=TypeConverters.toBoolean)
    stripAccents = Param(Params._dummy(), "stripAccents", "'unicode' or ''", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, analyzer="word", ngramMin=1, ngramMax=1,
                 lowercase=True, stripAccents=""):
        super().__init__()
        self._setDefault(analyzer="word", ngramMin=1, ngramMax=1, lowercase=True, stripAccents="")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        accents = self.getOrDefault(self.stripAccents) or None
        return with_terms(dataset, self.getInputCol(), self.getOutputCol(), self.getOrDefault(self.analyzer),
                          (self.getOrDefault(self.ngramMin), self.getOrDefault(self.ngramMax)),
                          self.getOrDefault(self.lowercase), accents)


def fit_vocabulary_lists(train: DataFrame, cfg: TfidfConfig, text_col: str = "clean_text",
                         id_col: str = "row_id") -> tuple[list[str], list[float]]:
    """The fitted vocabulary as (terms, idf) lists in index order (driver side,
    as Spark ML keeps it).  The length of the vectors is part of the model, so
    ``max_features`` must say it; ``tfidf_long`` takes any vocabulary."""
    if cfg.max_features is None:
        raise ValueError("vectors need max_features, the length of the model's vocabulary")
    terms, idf = _as_lists(fit_vocabulary(train, cfg, text_col, id_col)[0])
    if not terms:
        raise ValueError("empty vocabulary: no term passes min_df/max_df")
    return terms, idf


def fit_tfidf_stages(train: DataFrame, cfg: TfidfConfig, text_col: str, out_col: str,
                     id_col: str = "row_id", vocab: tuple[list[str], list[float]] | None = None) -> list:
    """J5/J6 as fitted stages: terms -> counts -> x idf -> L2 norm.

    The vocabulary comes from the relational fit above, so the vector form
    equals the long form term by term.
    """
    terms, idf = vocab if vocab is not None else fit_vocabulary_lists(train, cfg, text_col, id_col)
    tag = out_col
    return [
        TextTerms(inputCol=text_col, outputCol=f"{tag}_terms", analyzer=cfg.analyzer,
                  ngramMin=cfg.ngram_range[0], ngramMax=cfg.ngram_range[1], lowercase=cfg.lowercase,
                  stripAccents=cfg.strip_accents or ""),
        count_vectorizer(terms, f"{tag}_terms", f"{tag}_tf"),
        ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol=f"{tag}_tf", outputCol=f"{tag}_tfidf"),
        Normalizer(p=2.0, inputCol=f"{tag}_tfidf", outputCol=out_col),
    ]


def fit_features(train: DataFrame, spec: FeatureSpec, text_col: str = "clean_text",
                 out_col: str = "features", id_col: str = "row_id", vocabs: dict | None = None) -> PipelineModel:
    """Fitted feature pipeline; hybrid = word and char halves, each
    normalised, then concatenated.  ``vocabs`` may hold already fitted
    vocabularies keyed by ``TfidfConfig`` (shared across variants)."""
    vocabs = vocabs or {}
    if spec.feature_type == "word":
        stages = fit_tfidf_stages(train, spec.parts[0], text_col, out_col, id_col, vocabs.get(spec.parts[0]))
    elif spec.feature_type == "word_char_hybrid":
        stages = (fit_tfidf_stages(train, spec.parts[0], text_col, "word_tfidf", id_col, vocabs.get(spec.parts[0]))
                  + fit_tfidf_stages(train, spec.parts[1], text_col, "char_tfidf", id_col, vocabs.get(spec.parts[1]))
                  + [VectorAssembler(inputCols=["word_tfidf", "char_tfidf"], outputCol=out_col)])
    else:
        raise ValueError(f"no such feature_type: {spec.feature_type}")
    return PipelineModel(stages=stages)


def drop_feature_intermediates(df: DataFrame, keep: str = "features") -> DataFrame:
    """Remove the analyzer/tf columns the feature stages leave behind."""
    suffixes = ("_terms", "_tf", "_tfidf")
    drop = [c for c in df.columns if c != keep and (c.endswith(suffixes) or c in ("word_tfidf", "char_tfidf"))]
    return df.drop(*drop)

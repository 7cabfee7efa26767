"""Feature preparation as a fitted, storable pipeline of built-in Spark stages.

``TabularFeatures`` learns medians, modes, means, deviations and category lists from
the rows it is fitted on and returns a ``PipelineModel`` of SQL expressions, string
indexers, one-hot encoders and a vector assembler. Nothing but constants is learned,
so transforming stays inside code generation and works on streams as well.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import (
    OneHotEncoder,
    PolynomialExpansion,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import known, quoted
from ..functions.order_stats import exact_quantiles
from ..session import local_table

FEATURES = "features"


# MLlib cannot address a column whose name holds a dot, so inner names carry another sign.
_DOT = "\u2024"


def _inner(kind: str, name: str) -> str:
    return f"{kind}|{name.replace('.', _DOT)}"


def _source(inner: str) -> str:
    return inner.split("|", 1)[1].replace(_DOT, ".")


def _number(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The most frequent non-null text per column, the smallest on ties."""
    from .profiling import frequencies

    best = F.min(F.struct((-F.col("n")).alias("k"), F.col("value").alias("v")))["v"]
    rows = frequencies(df, columns).groupBy("column").agg(best.alias("v")).collect()
    return {r["column"]: r["v"] for r in rows}


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    rows = exact_quantiles(df, columns, [0.5]).collect()
    return {r["column"]: r["value"] for r in rows}


def moments(df: DataFrame, columns: Sequence[str], fill: dict[str, float]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column after imputation, in one pass."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.coalesce(known(df, c).cast("double"), F.lit(fill[c]))
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


class _TableParams(Params):
    numeric = Param(Params._dummy(), "numeric", "numeric inputs", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "text inputs", TypeConverters.toListString)
    scale = Param(Params._dummy(), "scale", "standardise numeric inputs", TypeConverters.toBoolean)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)


class TabularFeatures(Estimator, _TableParams, DefaultParamsReadable, DefaultParamsWritable):
    """Impute, standardise, one-hot encode and assemble; other columns stay untouched.

    Numbers take the exact median for NULL and, with ``scale``, become (x - mean) / sd
    with the population deviation (1 for a constant column). Text takes the most
    frequent value for NULL; categories are in ascending order, two categories keep
    the second only, and a value never seen becomes all zeros.
    """

    @keyword_only
    def __init__(self, *, numeric=None, categorical=None, scale=True, outputCol=FEATURES):
        super().__init__()
        self._setDefault(numeric=[], categorical=[], scale=True, outputCol=FEATURES)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> PipelineModel:
        numeric, categorical = self.getOrDefault("numeric"), self.getOrDefault("categorical")
        stages, inputs = [], []
        if numeric:
            fill = medians(df, numeric)
            empty = [c for c in numeric if c not in fill]
            if empty:
                raise ValueError(f"columns without any value: {empty}")
            centre = moments(df, numeric, fill) if self.getOrDefault("scale") else {}
            exprs = []
            for c in numeric:
                x = f"coalesce(nullif(CAST({quoted(c)} AS DOUBLE), DOUBLE('NaN')), {_number(fill[c])})"
                if centre:
                    mean, sd = centre[c]
                    x = f"({x} - {_number(mean)}) / {_number(sd or 1.0)}"
                name = _inner("num", c)
                exprs.append(f"{x} AS {quoted(name)}")
                inputs.append(name)
            stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__"))
        if categorical:
            mode = most_frequent(df, categorical)
            exprs = [
                f"coalesce(CAST({quoted(c)} AS STRING), {_text(mode[c])}) AS {quoted(_inner('txt', c))}"
                for c in categorical
            ]
            filler = SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")
            stages.append(filler)
            indexer = StringIndexer(
                inputCols=[_inner("txt", c) for c in categorical],
                outputCols=[_inner("idx", c) for c in categorical],
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            ).fit(filler.transform(df))
            # indices above the known categories are the dropped last slot: all zeros
            encoder = OneHotEncoder(
                inputCols=[_inner("idx", c) for c in categorical],
                outputCols=[_inner("hot", c) for c in categorical],
                dropLast=True,
            ).fit(indexer.transform(filler.transform(df)))
            stages += [indexer, encoder]
            for c, labels in zip(categorical, indexer.labelsArray):
                if len(labels) == 2:
                    stages.append(
                        VectorSlicer(inputCol=_inner("hot", c), outputCol=_inner("bin", c), indices=[1])
                    )
                    inputs.append(_inner("bin", c))
                else:
                    inputs.append(_inner("hot", c))
        out = self.getOrDefault("outputCol")
        stages.append(VectorAssembler(inputCols=inputs, outputCol=out))
        return PipelineModel(stages)


def feature_names(model: PipelineModel) -> list[str]:
    """Output names in vector order, like ``Type_L``, from a fitted feature pipeline."""
    inner = next((s for s in model.stages if isinstance(s, PipelineModel)), model)
    labels: dict[str, list[str]] = {}
    expansions: list[int] = [
        s.getDegree() for s in model.stages if isinstance(s, PolynomialExpansion)
    ]
    names: list[str] = []
    for stage in inner.stages:
        if hasattr(stage, "labelsArray"):
            for c, values in zip(stage.getInputCols(), stage.labelsArray):
                labels[_source(c)] = list(values)
        if isinstance(stage, VectorAssembler):
            for c in stage.getInputCols():
                kind, source = c.split("|", 1)[0], _source(c)
                if kind == "num":
                    names.append(source)
                else:
                    values = labels[source][1:] if kind == "bin" else labels[source]
                    names += [f"{source}_{v}" for v in values]
    for degree in expansions:
        names = polynomial_names(names, degree)
    return names


def polynomial_names(names: Sequence[str], degree: int) -> list[str]:
    """Names of the expanded terms in the order MLlib emits them.

    Terms with the last input come after all terms without it, by rising power.
    """

    def powers(k: int, budget: int) -> list[dict[int, int]]:
        if k < 0:
            return [{}]
        out = []
        for p in range(budget + 1):
            out += [{**t, k: p} if p else t for t in powers(k - 1, budget - p)]
        return out

    def label(term: dict[int, int]) -> str:
        parts = [names[i] if p == 1 else f"{names[i]}^{p}" for i, p in sorted(term.items())]
        return " ".join(parts)

    return [label(t) for t in powers(len(names) - 1, degree) if t]


# ----------------------------------------------------------------- engineered columns


_NUMBERS = {"tinyint", "smallint", "int", "integer", "bigint", "long", "float", "real", "double", "decimal"}


class FunctionStage(Transformer):
    """A DataFrame function as a pipeline stage; it cannot be stored."""

    def __init__(self, func: Callable[[DataFrame], DataFrame]):
        super().__init__()
        self.func = func

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.func(df)


@dataclass(frozen=True)
class AddedColumns:
    """A pipeline stage that adds columns, with their schema declared up front.

    The declared types say which of the columns are numbers and which are categories, so a pipeline
    over them can be laid out before any row is read. ``by_sql`` makes a stage that can be stored.
    """

    stage: Transformer
    schema: tuple[tuple[str, str], ...]
    reason: str = ""
    contact: str = ""

    @staticmethod
    def by_sql(reason: str = "", contact: str = "", **columns: tuple[str, str]) -> "AddedColumns":
        """Columns as name=(type, SQL expression); the stage casts each to its declared type."""
        cells = [f"CAST({expr} AS {kind}) AS {quoted(name)}" for name, (kind, expr) in columns.items()]
        stage = SQLTransformer(statement=f"SELECT {', '.join(['*', *cells])} FROM __THIS__")
        return AddedColumns(stage, tuple((name, kind) for name, (kind, _) in columns.items()), reason, contact)

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.schema]

    def split_by_type(self) -> tuple[list[str], list[str]]:
        numbers = [name for name, kind in self.schema if kind.lower().split("(")[0].strip() in _NUMBERS]
        return numbers, [n for n in self.names if n not in numbers]

    def applied(self, df: DataFrame) -> DataFrame:
        """The table with the columns; refuses a stage that does not add what was declared."""
        out = self.stage.transform(df)
        missing = set(self.names) - set(out.columns)
        if missing:
            raise ValueError(f"declared but not added: {sorted(missing)}")
        return out


# Per track; nothing is added unless a track has an entry.
ENGINEERED: dict[str, AddedColumns] = {}


def hook_stages(added: AddedColumns | None) -> list[Transformer]:
    """The first pipeline stages: none where nothing is added."""
    return [] if added is None else [added.stage]


def apply_feature(df: DataFrame, added: AddedColumns | None) -> DataFrame:
    return df if added is None else added.applied(df)


def with_feature(
    numeric: Sequence[str], categorical: Sequence[str], added: AddedColumns | None
) -> tuple[list[str], list[str]]:
    """Input lists with the added columns, by their declared types."""
    numbers, texts = added.split_by_type() if added else ([], [])
    return [*numeric, *numbers], [*categorical, *texts]


def hook_status(spark, added: Mapping[str, AddedColumns], tracks: Sequence[str]) -> DataFrame:
    """(track, state, detail): AWAITING INPUT, INCOMPLETE (no column or no reason) or COMPLETE."""
    facts = [(t, ", ".join(a.names), a.reason.strip(), a.contact) for t, a in added.items() if a is not None]
    known_ = local_table(spark, facts, "track string, adds string, reason string, contact string")
    wanted = local_table(spark, [(i, t) for i, t in enumerate(tracks)], "place int, track string")
    whole = (F.col("adds") != "") & (F.col("reason") != "")
    state = F.when(whole, "COMPLETE").when(~whole, "INCOMPLETE").otherwise("AWAITING INPUT")
    by = F.when(F.col("contact") != "", F.concat(F.lit(", by "), "contact")).otherwise("")
    detail = (
        F.when(whole, F.concat(F.lit("adds "), "adds", by))
        .when(~whole, "give it columns and a reason")
        .otherwise("nothing registered for this track")
    )
    return wanted.join(known_, "track", "left").orderBy("place").select(
        "track", state.alias("state"), detail.alias("detail")
    )


def vector_moments(df: DataFrame, names: Sequence[str], column: str = FEATURES) -> DataFrame:
    """(feature, mean, sd): moments of every slot of a vector column, one pass."""
    from pyspark.ml.functions import vector_to_array

    slots = df.select(vector_to_array(column).alias("_x"))
    aggs = []
    for i in range(len(names)):
        aggs += [
            F.avg(F.col("_x")[i]).alias(f"m{i}"),
            F.stddev_pop(F.col("_x")[i]).alias(f"s{i}"),
        ]
    cells = [
        F.struct(F.lit(n).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("sd"))
        for i, n in enumerate(names)
    ]
    return slots.agg(*aggs).select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")

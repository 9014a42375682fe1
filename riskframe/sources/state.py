"""A store of fitted state (A5): every fitted decision as rows of one typed, versioned table.

A saved object is a folder ``version=N`` of rows (part, name, position, place,
number, text).  Numbers are doubles, so they come back bit for bit; lists keep
their order through ``position`` and ``place``.  A version counts only when its
last row, the seal, holds the number of the others: a save that was cut off is
not seen.  Imputers, encoders, clippers, scalers, whole feature plans,
projections and fitted models can be saved and rebuilt, in any session and for
any source, streams included.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import encode
from riskframe.operators.clean import MedianImputer
from riskframe.operators.logistic import LogisticModel
from riskframe.operators.trees import Ensemble, Tree, TreeParams
from riskframe.spec import TableSpec

SCHEMA = "part string, name string, position int, place int, number double, text string"
#: The part of the row that closes a version.
SEAL = "sealed"


def _row(part: str, name: str = "", position: int = 0, place: int = 0, number: float | None = None, text: str | None = None):
    return part, name, position, place, None if number is None else float(number), text


def _numbers(part: str, found: dict) -> list[tuple]:
    return [_row(part, c, i, number=v) for i, (c, v) in enumerate(found.items())]


def _texts(part: str, found: Iterable[str], name: str = "") -> list[tuple]:
    return [_row(part, name, i, text=v) for i, v in enumerate(found)]


def _lists(part: str, found: Iterable[Iterable[float]]) -> list[tuple]:
    """Lists of numbers; an empty one leaves a row without a number."""
    out = []
    for i, values in enumerate(found):
        values = list(values)
        out += [_row(part, "", i, j, number=v) for j, v in enumerate(values)] or [_row(part, "", i, -1)]
    return out


class _Parts:
    """Rows of a version by part, in order."""

    def __init__(self, rows):
        self.rows: dict[str, list] = {}
        for r in sorted(rows, key=lambda r: (r.part, r.position, r.place)):
            self.rows.setdefault(r.part, []).append(r)

    def numbers(self, part: str) -> dict[str, float | None]:
        return {r.name: r.number for r in self.rows.get(part, [])}

    def texts(self, part: str) -> list[str]:
        return [r.text for r in self.rows.get(part, [])]

    def named_texts(self, part: str) -> dict[str, list[str]]:
        """Lists of texts by name; a name with an empty list has one row without text."""
        out: dict[str, list[str]] = {}
        for r in sorted(self.rows.get(part, []), key=lambda r: (r.position, r.place)):
            own = out.setdefault(r.name, [])
            if r.place >= 0:
                own.append(r.text)
        return out

    def lists(self, part: str) -> list[list[float]]:
        out: list[list[float]] = []
        for r in self.rows.get(part, []):
            while len(out) <= r.position:
                out.append([])
            if r.place >= 0:
                out[r.position].append(r.number)
        return out

    def one(self, part: str):
        found = self.rows.get(part)
        return None if not found else (found[0].number if found[0].number is not None else found[0].text)


# ---------------------------------------------------------------- what each kind holds

def _imputer_rows(x: MedianImputer, at: str = "median"):
    return _numbers(at, x.medians)


def _encoder_rows(x: encode.CategoryEncoder):
    out = [_row("missing_as", text=x.missing_as)] + _texts("dropped", x.dropped)
    for part, levels in (("label", x.label), ("one_hot", x.one_hot)):
        for i, (c, own) in enumerate(levels.items()):
            out += [_row(part, c, i, j, text=v) for j, v in enumerate(own)] or [_row(part, c, i, -1)]
    return out


def _encoder(p: _Parts) -> encode.CategoryEncoder:
    return encode.CategoryEncoder(p.named_texts("label"), p.named_texts("one_hot"), p.texts("dropped"), p.one("missing_as"))


def _pairs_rows(low: str, high: str, found: dict[str, tuple[float, float]]):
    return _numbers(low, {c: v[0] for c, v in found.items()}) + _numbers(high, {c: v[1] for c, v in found.items()})


def _pairs(p: _Parts, low: str, high: str) -> dict[str, tuple[float, float]]:
    second = p.numbers(high)
    return {c: (v, second[c]) for c, v in p.numbers(low).items()}


def _winsorizer_rows(x: encode.Winsorizer):
    return _pairs_rows("clip_low", "clip_high", x.bounds)


def _scaler_rows(x: encode.StandardScaler):
    return _pairs_rows("mean", "std", x.moments)


def _plan_rows(x):
    out = [_row("id", text=x.spec.id_col), _row("target", text=x.spec.target_col), _row("sentinel", number=x.sentinel_median)]
    out += _numbers("fill", x.feature_fills) + _texts("created", x.created) + _texts("correlated", x.dropped_corr) + _texts("kept", x.kept)
    out += _numbers("importance", x.importance) + _numbers("variance", x.variance) + _numbers("log", x.log)
    return out + _encoder_rows(x.encoder) + _winsorizer_rows(x.clipper) + _scaler_rows(x.scaler)


def _plan(p: _Parts):
    from riskframe.plans.featurize import FeaturePlan
    whole = {k: int(v) if float(v).is_integer() else v for k, v in p.numbers("log").items()}
    return FeaturePlan(TableSpec(p.one("id"), p.one("target")), p.one("sentinel"), p.numbers("fill"), p.texts("created"), _encoder(p),
                       encode.Winsorizer(_pairs(p, "clip_low", "clip_high")), encode.StandardScaler(_pairs(p, "mean", "std")),
                       p.texts("correlated"), p.texts("kept"), p.numbers("importance"), p.numbers("variance"), whole)


def _projection_rows(x):
    return (_texts("feature", x.features) + _numbers("median", x.medians) + _winsorizer_rows(x.clipper) + _scaler_rows(x.scaler)
            + _lists("loading", np.asarray(x.loadings).tolist()) + _lists("explained", [x.explained]) + _lists("centre", x.centres)
            + [_row("inertia", number=x.inertia)])


def _projection(p: _Parts):
    from riskframe.plans.explore import Projection
    return Projection(p.texts("feature"), p.numbers("median"), encode.Winsorizer(_pairs(p, "clip_low", "clip_high")),
                      encode.StandardScaler(_pairs(p, "mean", "std")), np.array(p.lists("loading")), p.lists("explained")[0],
                      p.lists("centre"), p.one("inertia"))


def _logistic_rows(x: LogisticModel):
    return _texts("feature", x.features) + _lists("weight", [x.weights.tolist()]) + [_row("passes", number=x.passes)]


def _ensemble_rows(x: Ensemble):
    out = _texts("feature", x.features) + _lists("cut", (c.tolist() for c in x.cuts)) + [_row("base", number=x.base)]
    for name, v in vars(x.params).items():
        out.append(_row("param", name, text=v) if isinstance(v, str) else _row("param", name, number=v))
    for column in ("feature", "cut", "left", "right", "value", "gain"):
        out += _lists(f"tree_{column}", (getattr(t, column) for t in x.trees))
    return out


def _ensemble(p: _Parts) -> Ensemble:
    like = TreeParams()
    params = {r.name: r.text if r.text is not None else type(getattr(like, r.name))(r.number) for r in p.rows["param"]}
    columns = {c: p.lists(f"tree_{c}") for c in ("feature", "cut", "left", "right", "value", "gain")}
    trees = [Tree(*([int(v) for v in columns[c][i]] for c in ("feature", "cut", "left", "right")), columns["value"][i], columns["gain"][i])
             for i in range(len(columns["left"]))]
    return Ensemble(tuple(p.texts("feature")), [np.array(c) for c in p.lists("cut")], trees, p.one("base"), TreeParams(**params))


#: Kind of object -> (its rows, the object from its rows).
KINDS = {
    "MedianImputer": (_imputer_rows, lambda p: MedianImputer(p.numbers("median"))),
    "CategoryEncoder": (_encoder_rows, _encoder),
    "Winsorizer": (_winsorizer_rows, lambda p: encode.Winsorizer(_pairs(p, "clip_low", "clip_high"))),
    "StandardScaler": (_scaler_rows, lambda p: encode.StandardScaler(_pairs(p, "mean", "std"))),
    "FeaturePlan": (_plan_rows, _plan),
    "Projection": (_projection_rows, _projection),
    "LogisticModel": (_logistic_rows, lambda p: LogisticModel(
        tuple(p.texts("feature")), np.array(p.lists("weight")[0]), int(p.one("passes")))),
    "Ensemble": (_ensemble_rows, _ensemble),
}


# ---------------------------------------------------------------- the store

def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all version folders, sealed or not, in order."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("version=") and n.split("=")[1].isdigit())


def save_state(spark: SparkSession, path: str, fitted) -> int:
    """Write a fitted object as the next version below ``path``; returns its number."""
    kind = type(fitted).__name__
    if kind not in KINDS:
        raise TypeError(f"no stored form for {kind}")
    rows = [_row("kind", text=kind), *KINDS[kind][0](fitted)]
    rows.append(_row(SEAL, number=len(rows)))
    version = max(_versions(spark, path), default=0) + 1
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("errorifexists").parquet(f"{path.rstrip('/')}/version={version}")
    return version


def read_state(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The rows of a version as a table."""
    return spark.read.schema(SCHEMA).parquet(f"{path.rstrip('/')}/version={version}")


def load_state(spark: SparkSession, path: str, version: int | None = None):
    """The object of a version (the newest sealed one by default); FileNotFoundError where there is none."""
    for v in [version] if version is not None else reversed(_versions(spark, path)):
        if v in _versions(spark, path):
            rows = read_state(spark, path, v).collect()     # one row per fitted decision
            seal = [r for r in rows if r.part == SEAL]
            if seal and seal[0].number == len(rows) - 1:
                parts = _Parts(rows)
                return KINDS[parts.one("kind")][1](parts)
    raise FileNotFoundError(f"no fitted state under {path}" if version is None else f"no fitted state {version} under {path}")


def score_frame(df: DataFrame, model, features, id_col: str) -> DataFrame:
    """(id, score) of new rows by a fitted block model; missing features count as missing bins or 0."""
    from functools import partial
    kind = df.schema[id_col].dataType.simpleString()
    flat = df.select(F.col(id_col).alias("id"), F.array(*[F.col(f"`{f}`").cast("double") for f in features]).alias("x"))
    return flat.mapInArrow(partial(_score_rows, model=model, width=len(features)), f"id {kind}, score double")


def _score_rows(batches, model, width: int):
    import pyarrow as pa
    for b in batches:
        x = b.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
        if isinstance(model, LogisticModel):
            x = np.nan_to_num(x)
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(model.score(x))], names=["id", "score"])

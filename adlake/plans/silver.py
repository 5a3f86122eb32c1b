"""Silver models: typed rows out of landing JSON, newest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions.jsonx import day, first_filled, surrogate_key, text
from adlake.functions.text import sanitise, sanitise_name
from adlake.operators.latest import latest_per_key, newer_than, with_deciding_text
from adlake.operators.pivot import Metric, metric_columns
from adlake.plans import specs
from adlake.plans.specs import DailySpec
from adlake.schemas import insight_payload

TIES = ("job_id", "data")


def _field(payload: Column, name: str, spare: str | None = None) -> Column:
    return text(first_filled(payload[name], payload[spare])) if spare else text(payload[name])


def settled(raw: DataFrame) -> DataFrame:
    """Landing rows with a column ``document``: ``data`` where rows share created_at and job_id, so that it may have to
    settle which is the newest, else null. ``newest`` then moves that instead of every document."""
    return with_deciding_text(raw, ["created_at", "job_id"], "data", "document")


def newest(raw: DataFrame, spec: DailySpec, carried: Sequence[Column], read: Sequence[str] | None = None) -> DataFrame:
    """Newest landing row per key: its key fields as ``key_<field>``, job_id, created_at and ``carried``, columns made of
    its payload ``p``.

    Documents are parsed before the versions are compared, so that typed columns are shuffled and sorted, and only
    those that are read later. A document that cannot be parsed whole is grouped by its key fields as read alone.

    ``read`` names the payload's text fields that ``carried`` uses, if it uses no others and no arrays: of a document
    then only these and the key are made. One that this parse refuses is parsed whole as well.
    """
    spare, broken = dict(spec.spares), "_corrupt_record"
    names = [*spec.key, *[s for f, s in spec.spares if f in spec.key]]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    payload = insight_payload((*spec.payload_fields, broken), spec.parents)
    tie = "document" if "document" in raw.columns else "data"
    rows = raw.select("job_id", "created_at", "data", F.col(tie).alias("document"))
    if read is None:
        parsed = rows.withColumn("p", F.from_json("data", payload))
    else:
        # a document whose tokens are sound gives the same text for a field whatever other fields are asked for
        some = list(dict.fromkeys([*names, *read, broken]))
        part = rows.withColumn("p", F.from_json("data", insight_payload(some, ())))
        whole = part.withColumn("w", F.when(F.col("p")[broken].isNotNull(), F.from_json("data", payload)))
        field = lambda n: F.when(F.col("p")[broken].isNull(), F.col("p")[n]).otherwise(F.col("w")[n]).alias(n)
        parsed = whole.withColumn("p", F.struct(*[field(n) for n in some])).drop("w")
    p = F.col("p")
    alone = F.when(p[broken].isNull(), F.struct(*[p[n].alias(n) for n in names])).otherwise(F.from_json("data", schema))
    rows = parsed.select("job_id", "created_at", "document", "p", alone.alias("k")).select(
        "job_id", "created_at", "document",
        *[_field(F.col("k"), n, spare.get(n)).alias(f"k_{n}") for n in spec.key],
        *[F.when(p[broken].isNotNull(), _field(p, n, spare.get(n))).alias(f"p_{n}") for n in spec.key],
        *carried,
    )
    keys = [f"k_{n}" for n in spec.key]
    top = latest_per_key(rows, keys, "created_at", ("job_id", "document"))
    for n in spec.key:
        top = top.withColumn(f"key_{n}", F.coalesce(f"p_{n}", f"k_{n}"))
    return top.drop("document", *keys, *[f"p_{n}" for n in spec.key])


def daily(raw: DataFrame, spec: DailySpec, since=None, strict_dates: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """A daily model from landing rows (only those after ``since``, if given). ``columns`` names those wanted, if not
    all are: where they are texts and dates, the documents' other fields are not made."""
    p, spare = F.col("p"), dict(spec.spares)
    wanted = lambda c: columns is None or c in columns
    metrics = [m for m in [*[Metric(s, s) for s in spec.scalars], *spec.metrics] if wanted(m.name)]
    texts = [(out, f) for out, f in spec.texts if wanted(out)]
    own = [(out, f) for out, f in texts if f not in spec.key]
    days = [d for d in ("date_start", "date_stop") if wanted(d)]
    others = [_field(p, f, spare.get(f)).alias(out) for out, f in own]
    # strict dates stay text until the newest row is chosen: an old version's may be wrong
    dates = [(p[d] if strict_dates else day(p[d])).alias(d) for d in days]
    read = None if metrics else [*[f for _, f in own], *[spare[f] for _, f in own if f in spare], *days]
    rows = newest(newer_than(raw, since), spec, [*others, *dates, *metric_columns("p", metrics)], read)
    return rows.select(
        *([surrogate_key(*[F.col(f"key_{k}") for k in spec.key]).alias("surrogate_key")] if wanted("surrogate_key") else []),
        *[c for c in ("job_id", "created_at") if wanted(c)],
        *[F.col(f"key_{f}" if f in spec.key else out).alias(out) for out, f in texts],
        *[(day(F.col(d), True) if strict_dates else F.col(d)).alias(d) for d in days],
        *[m.name for m in metrics],
    )


def settled_daily(raw: DataFrame, spec: DailySpec, columns: Sequence[str] | None = None) -> DataFrame:
    """``daily`` of rows that can be read twice: documents are carried only where they may have to settle the newest row."""
    return daily(settled(raw), spec, columns=columns)


def entity(raw: DataFrame, columns: Sequence[tuple[str, str]], templates: Sequence[str], since=None) -> DataFrame:
    """Newest entity row per id out of the shared table, for the given templates.

    Template names are compared in sanitised form, so ``Ad Creative Daily Report``
    and ``AD_CREATIVE_DAILY_REPORT`` are the same.
    """
    fields = list(dict.fromkeys([f for _, f in columns] + ["_template"]))
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    wanted = [sanitise_name(t) for t in templates]
    parsed = newer_than(raw, since).select("job_id", "created_at", "data", F.from_json("data", schema).alias("p"))
    rows = parsed.filter(sanitise(F.col("p._template")).isin(*wanted)).select(
        "job_id", "created_at", "data", *[text(F.col("p")[f]).alias(out) for out, f in columns]
    )
    return latest_per_key(rows, ["id"], "created_at", TIES).drop("data")


def ad_metadata(raw: DataFrame, since=None) -> DataFrame:
    return entity(raw, specs.AD_ENTITY, specs.AD_ENTITY_TEMPLATES, since)


def ad_set_metadata(raw: DataFrame, since=None) -> DataFrame:
    return entity(raw, specs.AD_SET_ENTITY, specs.AD_SET_ENTITY_TEMPLATES, since)

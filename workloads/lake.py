"""Table lifecycle, reports on disk, models and production scoring."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import evaluation, model, selection
from tidemark.plans.clean import CleanPlan, fill_nulls, fit_clean
from tidemark.plans.encode import fit_encode
from tidemark.plans.production import ProductionPlan, score_production
from tidemark.plans.trees import TreePlan
from tidemark.sources import lake
from tidemark.sources.staging import fresh_path, stage
from workloads import spine as spine_queries
from workloads.fixtures import KEYS, NUMERIC, OPTIONS, SPINE, TEXT, new_schema, rounded, score_history, spine_cm, split_dataset
from workloads.selection import TIDY_LABEL, cramers_v, importance_facts, importance_query
from workloads.spine import ORACLE as SPINE_ORACLE
from workloads.selection import ORACLE as SELECTION_ORACLE
from workloads.sql import query

EARLY, LATE = "20240101_000000", "20240201_000000"
FEATURES = [*NUMERIC, *TEXT]
SPINE_COLUMNS = [*KEYS, "target", "ind_split"]


def save_partitioned(spark, sf_dir):
    name = lake.save_versioned(spine_cm(spark, sf_dir), new_schema(spark), "spine", EARLY, partition_by=["month"])
    return spark.read.table(name)


def save_bucketed(spark, sf_dir):
    """Two versions bucketed alike, joined without a shuffle."""
    schema, rows = new_schema(spark), spine_cm(spark, sf_dir)
    left = lake.save_versioned(rows, schema, "spine", EARLY, bucket_by=(8, KEYS))
    right = lake.save_versioned(rows.withColumnRenamed("target", "outcome"), schema, "outcome", EARLY, bucket_by=(8, KEYS))
    return spark.read.table(left).join(spark.read.table(right), KEYS, "left")


def latest_version(spark, sf_dir):
    schema, rows = new_schema(spark), spine_cm(spark, sf_dir)
    lake.save_versioned(rows.withColumn("target", 1 - F.col("target")), schema, "spine", EARLY)
    lake.save_versioned(rows, schema, "spine", LATE)
    lake.save_versioned(rows.withColumn("target", F.lit(-1)), schema, "spine_prod", LATE)
    return lake.read_latest(spark, schema, "spine")


def latest_partition(spark, sf_dir):
    """The last run of all months, found in the catalog's list of partitions."""
    name = f"{new_schema(spark)}.history"
    lake.append_or_create(score_history(spark, sf_dir), name, ["month", "exec_time"])
    return lake.last_slice(spark, name, "month").select("ident", "month", "p", "prediction", "exec_time")


def latest_partition_per_date(spark, sf_dir):
    """The last run of the last month: its partition from the catalog, its stamp from the rows."""
    name = f"{new_schema(spark)}.history"
    lake.append_or_create(score_history(spark, sf_dir, late=True), name, ["month"])
    return lake.last_slice(spark, name, "month", per_date=True).select("ident", "month", "p", "prediction", "exec_time")


def append_or_create(spark, sf_dir):
    """Created, appended, and one part written again without doubling it."""
    name, rows = f"{new_schema(spark)}.scores", spine_cm(spark, sf_dir)
    early, late = rows.where("month < '1999-01-01'"), rows.where("month >= '1999-01-01'")
    lake.append_or_create(early, name, ["month"])
    lake.append_or_create(late, name, ["month"])
    lake.append_or_create(late, name, ["month"], replace=True)
    return spark.read.table(name)


def append_run(spark, sf_dir):
    """Two runs, one of them tried again after its end and one after a try that died."""
    name, rows = f"{new_schema(spark)}.scores", spine_cm(spark, sf_dir)
    early, late = rows.where("month < '1999-01-01'"), rows.where("month >= '1999-01-01'")
    lake.append_run(early, name, "1998", ["month"])
    lake.append_or_create(late.withColumn(lake.RUN_PART, F.lit("1999-died")), name)
    lake.append_run(late, name, "1999", ["month"])
    if lake.append_run(late, name, "1999", ["month"]):
        raise AssertionError("a finished run was written again")
    return lake.committed_rows(spark, name)


def guarded_drop(spark, sf_dir):
    schema, rows = new_schema(spark), spine_cm(spark, sf_dir)
    parts = [lake.save_versioned(rows, schema, f"part_{i}", EARLY) for i in (0, 1)]
    empty = lake.save_versioned(rows.where(F.lit(False)), schema, "empty", EARLY)
    kept = not lake.drop_if_written(spark, empty, parts)
    written = lake.save_versioned(spark.read.table(parts[0]), schema, "dataset", EARLY)
    dropped = lake.drop_if_written(spark, written, parts)
    left = len(spark.catalog.listTables(schema))
    return spark.read.table(written).agg(
        F.count(F.lit(1)).alias("n"), F.lit(kept).alias("kept"), F.lit(dropped).alias("dropped"),
        F.lit(left).cast("bigint").alias("tables_left"),
    )


def report_roundtrip(spark, sf_dir):
    report, path = spine_queries.prior_report(spark, sf_dir), fresh_path(spark, "prior")
    lake.save_report(report, path)
    if lake.read_if_present(spark, path + "-missing", report.schema) is not None:
        raise AssertionError("a report that was never written was read")
    return lake.read_report(spark, path, report.schema)


def feature_list_roundtrip(spark, sf_dir):
    ranked = selection.choose_features(
        cramers_v(spark, sf_dir), replace(OPTIONS, feat_mode="cramer", criterion="top", top=5)
    )
    path = fresh_path(spark, "chosen")
    lake.save_features(spark, ranked, path)
    rows = list(enumerate(lake.read_features(spark, path)))
    return spark.createDataFrame(rows, "position int, feature string")


def _fitted(spark, sf_dir):
    """Cleaned, encoded rows with the plans that made them. Rows are staged where
    they are costly, raw and clean, and a label's column is made as it is read."""
    raw = stage(split_dataset(spark, sf_dir).select(*SPINE_COLUMNS, *FEATURES))
    cleaner = fit_clean(raw, OPTIONS)
    cleaned = stage(cleaner.transform(raw))
    encoder = fit_encode(cleaned.where("ind_split = 'train'"), [c for c in TEXT if c in cleaner.columns])
    return raw, encoder.dummies(cleaned), cleaner, encoder


def _model(rows):
    features = [c for c in rows.columns if c not in SPINE.all()]
    return model.train_gbt(rows.where("ind_split = 'train'"), features, "target")


def train_gbt(spark, sf_dir):
    """The train rows, whether the model separates them better than their prior does,
    and whether it predicts alike after a trip to disk."""
    _, rows, _, _ = _fitted(spark, sf_dir)
    fitted, path = _model(rows), fresh_path(spark, "model")
    lake.save_fitted(fitted, path)
    known = fitted.transform(rows.where("ind_split = 'train'")).select(
        "ind_split", "target", *model.model_columns(fitted), vector_to_array("probability")[1].alias("p")
    )
    both = lake.load_fitted(PipelineModel, path).transform(known.withColumnRenamed("p", "first"))
    judged = stage(both.select("ind_split", "target", "first", vector_to_array("probability")[1].alias("p")))
    areas = evaluation.area_metrics(judged, "target", "p", ["ind_split"])
    counts = judged.groupBy("ind_split").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("first") == F.col("p")).alias("loaded_alike")
    )
    return counts.join(areas, "ind_split").select(
        "ind_split", "n", (F.col("areaUnderROC") > 0.5).alias("above_prior"), "loaded_alike"
    )


def predict(spark, sf_dir):
    """Predictions of all splits, saved and read back with their vectors:
    rows per split, and whether every probability pair and class is valid."""
    _, rows, _, _ = _fitted(spark, sf_dir)
    predicted = model.predict(_model(rows), rows, model.spine_of(rows, SPINE))
    name = lake.save_versioned(predicted, new_schema(spark), "pred", EARLY)
    pair = vector_to_array("probability")
    valid = (F.abs(pair[0] + pair[1] - 1) < 1e-9) & ((pair[1] > 0.5) == (F.col("prediction") == 1.0))
    return spark.read.table(name).groupBy("ind_split").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(valid).alias("valid")
    )


def boosted_stumps(spark, sf_dir):
    """Two rounds of trees of one split, scored by expressions: probabilities of all rows."""
    texts = ["segment", "returnflag"]
    filled = fill_nulls(split_dataset(spark, sf_dir).select(*SPINE_COLUMNS, "c_nationkey", *texts), SPINE.all())
    rows = stage(filled)
    encoder = fit_encode(rows.where("ind_split = 'train'"), texts)
    rows = encoder.dummies(rows)
    features = ["c_nationkey", *encoder.dummy_sources()]
    fitted = model.train_gbt(rows.where("ind_split = 'train'"), features, "target", maxDepth=1, maxIter=2)
    scored = TreePlan.of(fitted).score(rows, [*KEYS, "ind_split"])
    return scored.withColumn("score", F.round("score", 9))


def feature_importance_gbt(spark, sf_dir):
    """A row per model column; the importances are shares of one."""
    _, rows, _, _ = _fitted(spark, sf_dir)
    return importance_facts(model.gbt_importance(_model(rows), rows))


def refit_encoders(spark, sf_dir):
    """Encoders refitted on the source columns of chosen features, saved and loaded."""
    raw, rows, _, encoder = _fitted(spark, sf_dir)
    chosen = [c for c in rows.columns if c.startswith(("segment_", "returnflag_", "total_price"))]
    sources = encoder.original_features(chosen)
    cleaner = fit_clean(raw.select(*KEYS, "target", "ind_split", *sources), OPTIONS, drop=False)
    cleaned = stage(cleaner.transform(raw))
    plan = fit_encode(cleaned, [c for c in ("segment", "returnflag") if c in sources])
    path = fresh_path(spark, "encoders")
    lake.save_fitted(plan.encoder(cleaned), path)
    again = lake.load_fitted(PipelineModel, path).transform(cleaned)
    return again.groupBy("segment", F.col("segment_idx").cast("int").alias("segment_idx")).agg(
        F.count(F.lit(1)).alias("n")
    )


def production(spark, sf_dir):
    """Production scores by plans and model loaded from disk, appended to a
    history: rows per bucket, and whether both scores agree."""
    raw, rows, cleaner, encoder = _fitted(spark, sf_dir)
    plan = ProductionPlan(cleaner, encoder, _model(rows))
    path = fresh_path(spark, "production")
    plan.save(spark, path)
    candidates = raw.drop("target", "ind_split")
    scored = score_production(candidates, ProductionPlan.load(spark, path), OPTIONS, stamp=LATE)
    name = f"{new_schema(spark)}.score_prod"
    lake.append_or_create(scored, name, ["month"])
    logit = F.ln(F.col("score") / (1 - F.col("score")))
    return spark.read.table(name).groupBy("deciles", "exec_time").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.abs(logit - F.col("score_alt")) < 1e-6).alias("valid")
    )


def plan_roundtrip(spark, sf_dir):
    """A cleaning plan applied after a trip through its JSON form."""
    rows = stage(split_dataset(spark, sf_dir).select(*KEYS, "target", "ind_split", *FEATURES))
    path = fresh_path(spark, "plan")
    lake.save_text(spark, fit_clean(rows, OPTIONS).to_json(), path)
    plan = CleanPlan.from_json(lake.read_text(spark, path))
    return plan.transform(rows).select(*KEYS, "sum_qty", "returnflag", "segment")


QUERIES = {
    "save_partitioned": save_partitioned,
    "save_bucketed": save_bucketed,
    "latest_version": latest_version,
    "latest_partition": latest_partition,
    "latest_partition_per_date": latest_partition_per_date,
    "append_or_create": append_or_create,
    "append_run": append_run,
    "guarded_drop": guarded_drop,
    "report_roundtrip": report_roundtrip,
    "feature_list_roundtrip": feature_list_roundtrip,
    "plan_roundtrip": plan_roundtrip,
    "train_gbt": train_gbt,
    "predict": predict,
    "boosted_stumps": boosted_stumps,
    "feature_importance_gbt": feature_importance_gbt,
    "refit_encoders": refit_encoders,
    "score_production": production,
}

_STUMP_FEATURES = {"c_nationkey": "coalesce(c_nationkey, 0)"} | {
    f"{c}_{v}": f"cast(coalesce({c}, 'SIN_INFO') = '{v}' as integer)"
    for c, labels in (
        ("segment", ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")),
        ("returnflag", ("A", "N", "R", "SIN_INFO")),
    )
    for v in labels
}


def _stump(label: str) -> str:
    """The split of least squares of ``label`` on train rows, with both means."""
    return f"""
        select feature, (value + next) / 2 as threshold, s / n as low, (all_s - s) / (all_n - n) as high from (
          select feature, value, lead(value) over w as next, sum(n) over w as n, sum(s) over w as s,
            sum(n) over (partition by feature) as all_n, sum(s) over (partition by feature) as all_s
          from (select feature, value, count(*) as n, sum({label}) as s from stump_long group by 1, 2)
          window w as (partition by feature order by value))
        where next is not null order by s * s / n + (all_s - s) * (all_s - s) / (all_n - n) desc limit 1"""


def _stump_rounds() -> dict[str, str]:
    """Squares on the classes, then on 4 y / (1 + exp(2 y F)); the second tree counts a tenth."""
    columns = ", ".join(f"cast({sql} as double) as {name}" for name, sql in _STUMP_FEATURES.items())
    names = ", ".join(_STUMP_FEATURES)

    def leaf(source: str, row: str = "") -> str:
        value = " ".join(f"when '{c}' then {row}{c}" for c in _STUMP_FEATURES)
        return f"(select case when (case feature {value} end) <= threshold then low else high end from {source})"

    return {
        "stump_rows": f"select ident, month, ind_split, cast(2 * target - 1 as double) as y, {columns} from split_dataset",
        "stump_long": f"unpivot (select ident, month, y, {names} from stump_rows where ind_split = 'train') on {names} into name feature value value",
        "first_tree": _stump("y"),
        "first_round": f"select *, {leaf('first_tree')} as f from stump_rows",
        "second_long": f"unpivot (select ident, month, 4 * y / (1 + exp(2 * y * f)) as r, {names} from first_round where ind_split = 'train') on {names} into name feature value value",
        "second_tree": _stump("r").replace("stump_long", "second_long"),
        "second_round": f"select *, f + 0.1 * {leaf('second_tree')} as margin from first_round",
    }


ORACLE = {
    "boosted_stumps": query(
        """select ident, month, ind_split, round(1 / (1 + exp(-2 * margin)), 9) as score,
           cast(margin > 0 as integer)::double as prediction from second_round""",
        "split_dataset",
        **_stump_rounds(),
    ),
    "save_partitioned": query("select * from spine_cm", "spine_cm"),
    "save_bucketed": query("select *, target as outcome from spine_cm", "spine_cm"),
    "latest_version": query("select * from spine_cm", "spine_cm"),
    "latest_partition": query(
        """select * from history where month = (select max(month) from history)
           and exec_time = (select max(exec_time) from history)""",
        "history",
    ),
    "latest_partition_per_date": query(
        """select * from late_history where month = (select max(month) from late_history) and exec_time =
           (select max(exec_time) from late_history where month = (select max(month) from late_history))""",
        "late_history",
    ),
    "append_or_create": query("select * from spine_cm", "spine_cm"),
    "append_run": query("select * from spine_cm", "spine_cm"),
    "guarded_drop": query(
        "select count(*) as n, true as kept, true as dropped, cast(2 as bigint) as tables_left from spine_cm", "spine_cm"
    ),
    "report_roundtrip": SPINE_ORACLE["prior_report"],
    "feature_list_roundtrip": SELECTION_ORACLE["chosen_features"],
    "plan_roundtrip": query(
        """select ident, month, coalesce(sum_qty, 0) as sum_qty, coalesce(returnflag, 'SIN_INFO') as returnflag,
           segment from split_dataset""",
        "split_dataset",
    ),
    "train_gbt": query(
        "select ind_split, count(*) as n, true as above_prior, true as loaded_alike from split_dataset where ind_split = 'train' group by 1",
        "split_dataset",
    ),
    "feature_importance_gbt": importance_query(TIDY_LABEL),
    "predict": query("select ind_split, count(*) as n, true as valid from split_dataset group by 1", "split_dataset"),
    "score_production": query(
        """select cast(tile as integer) as deciles, '20240201_000000' as exec_time, count(*) as n, true as valid
           from (select ntile(10) over (order by month, ident) as tile from dataset) group by 1""",
        "dataset",
    ),
    "refit_encoders": query(
        """select segment, cast(row_number() over (order by count(*) desc, segment) - 1 as integer) as segment_idx,
           count(*) as n from dataset group by 1""",
        "dataset",
    ),
}

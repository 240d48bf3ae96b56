"""Profiles, cleaning, encoding and joins."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import merge, profile, state
from tidemark.operators.model import assemble
from tidemark.plans import clean
from tidemark.plans.encode import fit_encode
from tidemark.plans.labels import fit_labels
from tidemark.sources.staging import stage
from workloads.fixtures import (
    DIRTY,
    END,
    KEYS,
    NUMERIC,
    OPTIONS,
    SPINE,
    START,
    TEXT,
    dataset,
    dirty,
    feat_lineitem,
    feat_orders,
    new_schema,
    rounded,
    score_history,
    spine_window,
    split_dataset,
)
from workloads.sql import FIRST, LAST, query

PROFILED = [*NUMERIC, *TEXT, *DIRTY]
FLAGS = ["flag_yn", "flag_01", "two_level"]


def column_families(spark, sf_dir):
    """Every column of the dataset with its family and its number of values."""
    rows = dataset(spark, sf_dir)
    numbers, texts = profile.numeric_columns(rows), profile.string_columns(rows)
    counts = rows.agg(*[F.count(c).alias(c) for c in rows.columns]).unpivot([], rows.columns, "column", "n")
    family = F.when(F.col("column").isin(numbers), "number").when(F.col("column").isin(texts), "text").otherwise("other")
    return counts.withColumn("family", family)


def clean_strings(spark, sf_dir):
    return clean.clean_strings(dirty(spark, sf_dir), exclude=["ident"])


def null_profile(spark, sf_dir):
    return rounded(profile.null_profile(dataset(spark, sf_dir), PROFILED))


def drop_null_columns(spark, sf_dir):
    rows = stage(dataset(spark, sf_dir))
    first = profile.first_look(rows, PROFILED, OPTIONS.step_size)
    return rows.drop(*profile.null_heavy(first, OPTIONS.null_threshold))


def distinct_profile(spark, sf_dir):
    return profile.mode_profile(dataset(spark, sf_dir), PROFILED).select("column", "n_distinct")


def _kept_state(spark, sf_dir, rows):
    """The state of all months, kept in two runs: the second adds the later half."""
    name, columns = f"{new_schema(spark)}.profile", [*PROFILED]
    months = [r["month"] for r in rows.select("month").distinct().orderBy("month").collect()]
    early = rows.where(F.col("month") < months[len(months) // 2])
    state.keep_state(spark, name, early, "month", columns, OPTIONS.rsd)
    return state.keep_state(spark, name, rows, "month", columns, OPTIONS.rsd)


def distinct_approx(spark, sf_dir):
    """Exact counts, and whether the merged sketches came within three standard errors."""
    rows = stage(dataset(spark, sf_dir))
    sketched = state.merge_state(_kept_state(spark, sf_dir, rows)).select("column", F.col("n_distinct").alias("sketched"))
    exact = profile.mode_profile(rows, PROFILED).select("column", "n_distinct")
    near = F.abs(F.col("sketched") - F.col("n_distinct")) <= 3 * OPTIONS.rsd * F.col("n_distinct")
    return sketched.join(exact, "column").select("column", "n_distinct", near.alias("near"))


def profile_merged(spark, sf_dir):
    """Null shares, moments and ranges of the last twelve months, merged from their states."""
    rows = stage(dataset(spark, sf_dir))
    kept = _kept_state(spark, sf_dir, rows)
    last = kept.select("period").distinct().orderBy(F.desc("period")).limit(12)
    merged = state.merge_state(kept.join(last, "period", "left_semi"))
    return rounded(merged.drop("n_distinct", "var_pop", "low_text", "high_text"), 4)


def mode_profile(spark, sf_dir):
    return rounded(profile.mode_profile(dataset(spark, sf_dir), PROFILED).select("column", "mode_share"))


def heavy_values(spark, sf_dir):
    return rounded(profile.heavy_values(stage(dataset(spark, sf_dir)), PROFILED, 0.3))


def drop_quasi_constant(spark, sf_dir):
    rows = stage(dataset(spark, sf_dir))
    first = profile.first_look(rows, PROFILED, OPTIONS.step_size)
    second = profile.second_look(rows, PROFILED, first, OPTIONS.step_size)
    return rows.drop(*profile.quasi_constant(second, OPTIONS.null_threshold))


def drop_low_variance(spark, sf_dir):
    rows = stage(dataset(spark, sf_dir))
    columns = [c for c in profile.numeric_columns(rows, KEYS + ["target"])]
    first = profile.first_look(rows, columns, OPTIONS.step_size, variance=True)
    return rows.drop(*profile.low_variance(first, OPTIONS.varc_threshold))


def variance_profile(spark, sf_dir):
    found = profile.variance_profile(dataset(spark, sf_dir), ["n_orders", "sum_qty", "avg_discount", "flag_01"])
    return rounded(found, 4)


def binary_columns(spark, sf_dir):
    rows = clean.tidy(dirty(spark, sf_dir), ["ident"])
    return profile.binary_profile(stage(rows), [c for c in rows.columns if c != "ident"])


def encode_binary(spark, sf_dir):
    rows = clean.tidy(dirty(spark, sf_dir).select("ident", *FLAGS), ["ident"])
    first = profile.first_look(rows, FLAGS, OPTIONS.step_size)
    pairs = profile.binary_values(first, profile.second_look(rows, FLAGS, first, OPTIONS.step_size))
    return rows.withColumns({c: clean.encode_binary(F.col(c), *pair) for c, pair in pairs.items()})


def fill_nulls(spark, sf_dir):
    return clean.fill_nulls(dataset(spark, sf_dir).select(*KEYS, *PROFILED), KEYS, bin_input=["flag_01"])


def clean_dataset(spark, sf_dir):
    """Every cleaning step in order, by one fitted plan."""
    rows = stage(dataset(spark, sf_dir))
    return clean.fit_clean(rows, OPTIONS).transform(rows)


def drop_columns(spark, sf_dir):
    return dataset(spark, sf_dir).drop("all_null", "constant_txt", "messy")


def select_features(spark, sf_dir):
    return dataset(spark, sf_dir).select(*KEYS, "total_price", "segment", "sum_qty")


def join_left_features(spark, sf_dir):
    return merge.join_features(spine_window(spark, sf_dir), feat_lineitem(spark, sf_dir), KEYS)


def merge_cleaned(spark, sf_dir):
    spine = spine_window(spark, sf_dir)
    tables = [
        merge.join_features(spine, feat_orders(spark, sf_dir), KEYS),
        merge.join_features(spine, feat_lineitem(spark, sf_dir), KEYS),
    ]
    return merge.merge_cleaned(spine, tables, [*KEYS, "target"], KEYS)


def merge_windowed(spark, sf_dir):
    orders = feat_orders(spark, sf_dir).withColumnsRenamed({"ident": "raw_ident", "month": "raw_month"})
    lines = feat_lineitem(spark, sf_dir).withColumnsRenamed({"ident": "raw_ident", "month": "raw_month"})
    sources = [merge.Source(t, "raw_ident", "raw_month") for t in (orders, lines)]
    return merge.merge_windowed(
        spine_window(spark, sf_dir), sources, tuple(KEYS), START, END, keep=["total_price", "top_status", "sum_qty"]
    )


def join_inner_outcome(spark, sf_dir):
    return merge.join_outcomes(score_history(spark, sf_dir), spine_window(spark, sf_dir), KEYS)


def _filled_texts(spark, sf_dir):
    rows = clean.fill_nulls(split_dataset(spark, sf_dir).select(*KEYS, "ind_split", *TEXT), SPINE.all())
    return stage(rows)


def string_index(spark, sf_dir):
    rows = _filled_texts(spark, sf_dir)
    indexed = fit_labels(rows.where("ind_split = 'train'"), TEXT).index(rows)
    return indexed.select(*KEYS, *[f"{c}_idx" for c in TEXT])


def one_hot(spark, sf_dir):
    rows = _filled_texts(spark, sf_dir)
    encoded = fit_labels(rows.where("ind_split = 'train'"), TEXT).one_hot(rows)
    return encoded.select(
        *KEYS, *[(F.array_position(vector_to_array(f"{c}_ohe"), 1.0) - 1).cast("int").alias(f"{c}_hot") for c in TEXT]
    )


def label_features(spark, sf_dir):
    """Numbers and all labels in one sparse vector, read back by its names."""
    columns = [*NUMERIC, *TEXT]
    rows = clean.fill_nulls(split_dataset(spark, sf_dir).select(*KEYS, "ind_split", *columns), SPINE.all())
    rows = stage(rows)
    table = fit_labels(rows.where("ind_split = 'train'"), TEXT)
    made = table.features(rows, columns).select(*KEYS, F.posexplode(vector_to_array("features")).alias("position", "value"))
    named = made.where("value != 0").join(table.names(columns), "position")
    return named.select(*KEYS, "feature", "source", F.round("value", 6).alias("value"))


def dummies(spark, sf_dir):
    rows = _filled_texts(spark, sf_dir)
    plan = fit_encode(rows.where("ind_split = 'train'"), ["returnflag", "segment"])
    return plan.dummies(rows).select(*KEYS, *plan.dummy_sources())


def assemble_vector(spark, sf_dir):
    rows = assemble(clean.fill_nulls(dataset(spark, sf_dir).select(*KEYS, *NUMERIC), KEYS), NUMERIC)
    return rows.select(*KEYS, F.posexplode(vector_to_array("features")).alias("position", "value"))


QUERIES = {
    "column_families": column_families,
    "clean_strings": clean_strings,
    "null_profile": null_profile,
    "drop_null_columns": drop_null_columns,
    "distinct_profile": distinct_profile,
    "distinct_approx": distinct_approx,
    "profile_merged": profile_merged,
    "mode_profile": mode_profile,
    "heavy_values": heavy_values,
    "drop_quasi_constant": drop_quasi_constant,
    "drop_low_variance": drop_low_variance,
    "variance_profile": variance_profile,
    "binary_columns": binary_columns,
    "encode_binary": encode_binary,
    "fill_nulls": fill_nulls,
    "clean_dataset": clean_dataset,
    "drop_columns": drop_columns,
    "select_features": select_features,
    "join_left_features": join_left_features,
    "merge_cleaned": merge_cleaned,
    "merge_windowed": merge_windowed,
    "join_inner_outcome": join_inner_outcome,
    "string_index": string_index,
    "one_hot": one_hot,
    "dummies": dummies,
    "label_features": label_features,
    "assemble_vector": assemble_vector,
}


def _safe(column: str) -> str:
    return f"regexp_replace(replace(upper(trim({column})), ' ', '_'), '[^a-zA-Z0-9_]', '', 'g')"


def _long(columns: list[str], source: str = "dataset") -> str:
    return " union all ".join(f"select '{c}' as \"column\", cast({c} as varchar) as value from {source}" for c in columns)


_DIRTY_TEXT = ["segment", "nation_name", "region_name", "messy", "constant_txt", "quasi_const", "flag_yn"]
_NUMBERS = [*NUMERIC, "all_null", "mostly_null", "flag_01", "two_level"]


def _numbers(c: str) -> str:
    value = f"{c}::double" if c in _NUMBERS else "null::double"
    found = {"mean": f"avg({value})", "var_samp": f"var_samp({value})", "low_number": f"min({value})", "high_number": f"max({value})"}
    return ", ".join(f"round({sql}, 4) as {name}" for name, sql in found.items())


_COUNTS = {
    "long": _long(PROFILED),
    "per_value": 'select "column", value, count(*) as n from long group by 1, 2',
    "profile": """select "column", count(value) as n_distinct,
                  coalesce(max(n) filter (where value is not null), 0) / sum(n) as mode_share
                  from per_value group by 1""",
}
_LABELLED = TEXT
_FILLER = "'SIN_INFO'"
_FILLED = ", ".join(f"coalesce({c}, 'SIN_INFO') as {c}" for c in _LABELLED)
_RANKS = {
    "filled": f"select ident, month, ind_split, {_FILLED} from split_dataset",
    **{
        f"rank_{c}": f"""select {c}, row_number() over (order by count(*) desc, {c}) - 1 as i
                         from filled where ind_split = 'train' group by 1"""
        for c in _LABELLED
    },
}
_INDEXES = " ".join(f"left join rank_{c} using ({c})" for c in _LABELLED)


def _index_columns(suffix: str) -> str:
    return ", ".join(
        f"cast(coalesce(rank_{c}.i, (select count(*) from rank_{c})) as integer) as {c}_{suffix}" for c in _LABELLED
    )


_CLEAN = """select ident, month, target, coalesce(n_orders, 0) as n_orders, coalesce(total_price, 0) as total_price,
    coalesce(max_price, 0) as max_price, coalesce({top_status}, 'SIN_INFO') as top_status,
    coalesce(sum_qty, 0) as sum_qty, coalesce(sum_price, 0) as sum_price, coalesce(avg_discount, 0) as avg_discount,
    coalesce({returnflag}, 'SIN_INFO') as returnflag, coalesce(c_acctbal, 0) as c_acctbal,
    coalesce(c_nationkey, 0) as c_nationkey, coalesce({segment}, 'SIN_INFO') as segment,
    coalesce({nation_name}, 'SIN_INFO') as nation_name, coalesce({region_name}, 'SIN_INFO') as region_name,
    coalesce({messy}, 'SIN_INFO') as messy,
    cast(coalesce(case upper(trim(flag_yn)) when 'Y' then 1 when 'N' then 0 end, 0) as integer) as flag_yn,
    cast(coalesce(flag_01, 0) as integer) as flag_01,
    cast(coalesce(case two_level when 7 then 1 when 3 then 0 end, 0) as integer) as two_level
    from dataset""".format(**{c: _safe(c) for c in (*TEXT, "messy")})

_FAMILIES = {c: "number" for c in ("ident", "target", *_NUMBERS)} | {"month": "other"}

ORACLE = {
    "column_families": query(
        " union all ".join(
            f"select '{c}' as \"column\", count({c}) as n, '{_FAMILIES.get(c, 'text')}' as family from dataset"
            for c in (*KEYS, "target", *PROFILED)
        ),
        "dataset",
    ),
    "clean_strings": query(
        f"select * replace ({', '.join(f'{_safe(c)} as {c}' for c in _DIRTY_TEXT)}) from dirty",
        "dirty",
    ),
    "null_profile": query(
        'select "column", round(avg(case when value is null then 1.0 else 0.0 end), 6) as null_share from long group by 1',
        "dataset",
        long=_long(PROFILED),
    ),
    "drop_null_columns": query("select * exclude (all_null, mostly_null) from dataset", "dataset"),
    "distinct_profile": query('select "column", n_distinct from profile', "dataset", **_COUNTS),
    "distinct_approx": query('select "column", n_distinct, true as near from profile', "dataset", **_COUNTS),
    "profile_merged": query(
        " union all ".join(
            f"""select '{c}' as "column", count(*) as n, round(count(*) filter (where {c} is null) / count(*), 4) as null_share,
                {_numbers(c)} from recent"""
            for c in PROFILED
        ),
        "dataset",
        recent="select * from dataset where month in (select distinct month from dataset order by month desc limit 12)",
    ),
    "mode_profile": query('select "column", round(mode_share, 6) as mode_share from profile', "dataset", **_COUNTS),
    "heavy_values": query(
        """select "column", value, n, round(n / all_n, 6) as share from (
             select *, sum(n) over (partition by "column") as all_n from per_value)
           where value is not null and n > 0.3 * all_n""",
        "dataset",
        **_COUNTS,
    ),
    "drop_quasi_constant": query("select * exclude (constant_txt, quasi_const) from dataset", "dataset"),
    "drop_low_variance": query("select * exclude (n_orders, avg_discount, flag_01, two_level) from dataset", "dataset"),
    "variance_profile": query(
        " union all ".join(
            f"select '{c}' as \"column\", round(var_samp({c}), 4) as variance from dataset"
            for c in ("n_orders", "sum_qty", "avg_discount", "flag_01")
        ),
        "dataset",
    ),
    "binary_columns": query(
        """select "column", min(value) as low, max(value) as high,
                  not coalesce(min(try_cast(value as double)) = 0 and max(try_cast(value as double)) = 1, false)
                  as needs_encoding
           from long where value is not null group by 1 having count(distinct value) = 2""",
        "dirty",
        tidied="select * replace (upper(trim(flag_yn)) as flag_yn, upper(trim(messy)) as messy) from dirty",
        long=_long(
            ["c_acctbal", "c_nationkey", "segment", "nation_name", "region_name", *DIRTY], "tidied"
        ),
    ),
    "encode_binary": query(
        """select ident, cast(case upper(trim(flag_yn)) when 'Y' then 1 when 'N' then 0 end as integer) as flag_yn,
           cast(flag_01 as integer) as flag_01, cast(case two_level when 7 then 1 when 3 then 0 end as integer) as two_level
           from dirty""",
        "dirty",
    ),
    "fill_nulls": query(
        "select ident, month, coalesce(cast(flag_01 as varchar), 'SIN_INFO') as flag_01, "
        + ", ".join(
            f"coalesce({c}, {0 if c in _NUMBERS else _FILLER}) as {c}" for c in PROFILED if c != "flag_01"
        )
        + " from dataset",
        "dataset",
    ),
    "clean_dataset": query(_CLEAN, "dataset"),
    "drop_columns": query("select * exclude (all_null, constant_txt, messy) from dataset", "dataset"),
    "select_features": query("select ident, month, total_price, segment, sum_qty from dataset", "dataset"),
    "join_left_features": query(
        "select * from spine left join feat_lineitem using (ident, month)", "spine", "feat_lineitem"
    ),
    "merge_cleaned": query(
        "select * from spine left join feat_orders using (ident, month) left join feat_lineitem using (ident, month)",
        "spine", "feat_orders", "feat_lineitem",
    ),
    "merge_windowed": query(
        f"""select ident, month, target, total_price, top_status, sum_qty from spine
           left join (select * from feat_orders where month between date '{FIRST}' and date '{LAST}') using (ident, month)
           left join (select * from feat_lineitem where month between date '{FIRST}' and date '{LAST}') using (ident, month)""",
        "spine", "feat_orders", "feat_lineitem",
    ),
    "join_inner_outcome": query("select * from history join spine using (ident, month)", "history"),
    "string_index": query(
        f"select ident, month, {_index_columns('idx')} from filled {_INDEXES}", "split_dataset", **_RANKS
    ),
    "one_hot": query(
        f"select ident, month, {_index_columns('hot')} from filled {_INDEXES}", "split_dataset", **_RANKS
    ),
    "dummies": query(
        "select ident, month, "
        + ", ".join(f"cast(returnflag = '{v}' as integer) as returnflag_{v}" for v in ("A", "N", "R", "SIN_INFO"))
        + ", "
        + ", ".join(
            f"cast(segment = '{v}' as integer) as segment_{v}"
            for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
        )
        + " from filled",
        "split_dataset",
        **_RANKS,
    ),
    "label_features": query(
        " union all ".join(
            f"select ident, month, '{c}' as feature, '{c}' as source, round(cast(coalesce({c}, 0) as double), 6) as value "
            f"from split_dataset where coalesce({c}, 0) <> 0"
            for c in NUMERIC
        )
        + " union all "
        + " union all ".join(
            f"select ident, month, '{c}_' || {c} as feature, '{c}' as source, cast(1 as double) as value from filled join rank_{c} using ({c})"
            for c in TEXT
        ),
        "split_dataset",
        **_RANKS,
    ),
    "assemble_vector": query(
        " union all ".join(
            f"select ident, month, {i}::integer as position, cast(coalesce({c}, 0) as double) as value from dataset"
            for i, c in enumerate(NUMERIC)
        ),
        "dataset",
    ),
}

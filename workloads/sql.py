"""The same views as SQL text, for the comparison engine."""

from __future__ import annotations

# The window of the queries whose feature is one.
FIRST, LAST = "1995-01-01", "2001-07-31"

_VIEWS = {
    "spine_cm": """
        select o_custkey as ident, cast(date_trunc('month', o_orderdate) as date) as month,
               cast(max(case when o_orderpriority = '1-URGENT' then 1 else 0 end) as integer) as target
        from orders group by 1, 2""",
    "spine": """
        select * from spine_cm""",
    "feat_orders": """
        select o_custkey as ident, cast(date_trunc('month', o_orderdate) as date) as month,
               count(*) as n_orders, round(sum(o_totalprice), 2) as total_price,
               max(o_totalprice) as max_price, max_by(o_orderstatus, o_orderkey) as top_status
        from orders group by 1, 2""",
    "feat_lineitem": """
        select o_custkey as ident, cast(date_trunc('month', l_shipdate) as date) as month,
               round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice), 2) as sum_price,
               round(avg(l_discount), 6) as avg_discount, max(l_returnflag) as returnflag
        from lineitem join orders on l_orderkey = o_orderkey group by 1, 2""",
    "feat_customer": """
        select c_custkey as ident, c_acctbal, c_nationkey, c_mktsegment as segment,
               n_name as nation_name, r_name as region_name
        from customer left join (select * from nation join region on n_regionkey = r_regionkey)
             on c_nationkey = n_nationkey""",
    "dirty": """
        select *, case when ident % 3 = 0 then '  ' || lower(segment) || ' '
                       when ident % 3 = 1 then segment else segment || ' / b2b' end as messy,
               'FIXED' as constant_txt, cast(null as double) as all_null,
               case when ident % 40 = 0 then c_acctbal end as mostly_null,
               case when ident % 40 = 1 then 'B' else 'A' end as quasi_const,
               case when ident % 3 = 0 then 'y ' else 'N' end as flag_yn,
               cast(ident % 2 as integer) as flag_01,
               case when ident % 5 = 0 then 7 else 3 end as two_level
        from feat_customer""",
    "dataset": """
        select * from spine left join feat_orders using (ident, month)
             left join feat_lineitem using (ident, month) left join dirty using (ident)""",
    "split_dataset": """
        select *, {split1} as ind_split from dataset""",
    "spine_split": """
        select *, {split1} as ind_split from spine""",
    "scored": """
        select ident, month, target, p, {split3} as ind_split, cast(p >= 0.5 as double) as prediction
        from (select ident, month, target,
                     least(greatest(floor(total_price / 10000) / 100, 0.0), 1.0) as p
              from spine left join feat_orders using (ident, month))""",
    "with_deciles": """
        select *, cast(ntile(10) over (partition by ind_split order by p desc, month, ident) as integer) as deciles
        from scored""",
    "history": """
        select ident, month, p, prediction, '20010801_000000' as exec_time from scored
        union all select ident, month, p, prediction, '20010901_000000' from scored
        where month = (select max(month) from scored)""",
    "late_history": """
        select * from history
        union all select ident, month, p, prediction, '20011001_000000' from scored
        where month = (select max(month) - interval 1 month from scored)""",
}

_NEEDS = {
    "spine": ["spine_cm"],
    "dirty": ["feat_customer"],
    "dataset": ["spine", "feat_orders", "feat_lineitem", "dirty"],
    "split_dataset": ["dataset"],
    "spine_split": ["spine"],
    "scored": ["spine", "feat_orders"],
    "with_deciles": ["scored"],
    "history": ["scored"],
    "late_history": ["history"],
}


def key_hash(seed: int) -> str:
    return f"cast('0x' || substr(md5('{seed}|' || ident || '|' || strftime(month, '%Y-%m-%d')), 1, 8) as bigint)"


def split_case(months: int, train_size: float = 0.7) -> str:
    last = f"(select min(month) from (select distinct month from spine order by month desc limit {months}))"
    return (
        f"case when month >= {last} then 'val' "
        f"when {key_hash(2012)} < cast({train_size} as double) * 4294967296 then 'train' else 'test' end"
    )


def query(body: str, *views: str, **extra: str) -> str:
    """``body`` with the named views and extra CTEs in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for view in views:
        add(view)
    parts = [f"{name} as ({_VIEWS[name].format(split1=split_case(1), split3=split_case(3))})" for name in order]
    parts += [f"{name} as ({text})" for name, text in extra.items()]
    return f"with {', '.join(parts)} {body}" if parts else body

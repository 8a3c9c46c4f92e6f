"""The same results in DuckDB SQL over the given tables, for comparison only."""

from __future__ import annotations

from lakebook import bindings as b
from lakebook.layout import BOOK_SUBJECT
from lakebook.plans.spec import BOOK, Feature, FeatureSpec

AS_OF = f"date '{b.AS_OF.isoformat()}'"
JULY = f"timestamp '{b.JULY:%Y-%m-%d %H:%M:%S}'"


def _case(column: str, names: dict[str, str]) -> str:
    whens = " ".join(f"when '{old}' then '{new}'" for old, new in names.items())
    return f"case {column} {whens} else {column} end"


SALES_SOURCE = f"""
    select concat(l_orderkey, '-', l_linenumber) as transaction_id,
           o_custkey as user_id,
           l_partkey as product_id,
           o_orderdate as dat_creation,
           cast(l_extendedprice as decimal(14,2)) as amount,
           l_quantity as quantity,
           {_case("o_orderpriority", b.PAYMENTS)} as payment_method,
           o_orderstatus as status
    from lineitem join orders on l_orderkey = o_orderkey
"""

# The newest sales batch: what one snapshot of the source gives once conformed.
SALES = f"""
    select strftime(dat_creation, '%Y%m%d') as ref,
           '{b.RUN_AUG}' as ts_proc,
           '{b.FILE_AUG}' as ts_file_generation,
           transaction_id,
           cast(user_id as varchar) as user_id,
           cast(product_id as varchar) as product_id,
           dat_creation,
           amount,
           cast(quantity as integer) as quantity,
           payment_method
    from ({SALES_SOURCE})
"""

PRODUCTS = f"""
    select '{b.FILE_AUG[:8]}' as ref,
           '{b.FILE_AUG}' as ts_file_generation,
           '{b.RUN_AUG}' as ts_proc,
           cast(p_partkey as varchar) as product_id,
           p_name as product_des,
           {_case("p_type", b.CATEGORIES)} as product_category
    from part
"""

USERS = f"""
    select '{b.FILE_AUG[:8]}' as ref,
           '{b.FILE_AUG}' as ts_file_generation,
           '{b.RUN_AUG}' as ts_proc,
           cast(c_custkey as varchar) as user_id,
           split_part(c_name, '#', 1) as first_name,
           split_part(c_name, '#', 2) as last_name,
           c_mktsegment as gender,
           concat(lower(split_part(c_name, '#', 2)), '@example.org') as email
    from customer
"""

_SALES_BODY = """transaction_id, user_id, product_id, dat_creation, amount, quantity,
    payment_method"""

RAW_SALES = " union all ".join(
    f"""select ref, '{run}' as ts_proc, '{file}' as ts_file_generation, {_SALES_BODY}
    from ({SALES}){"" if file == b.FILE_AUG else f" where dat_creation < {JULY}"}"""
    for file, run in b.SALES_RUNS
)

RAW_PRODUCTS = " union all ".join(
    f"""select '{file[:8]}' as ref, '{file}' as ts_file_generation, '{run}' as ts_proc,
    product_id, product_des,
    {"product_category" if file == b.FILE_AUG else "cast(null as varchar)"} as product_category
    from ({PRODUCTS})"""
    for file, run in b.PRODUCT_RUNS
)

_KEY = {
    "sales": "concat(ts_proc, ts_file_generation)",
    "products": "concat(ts_file_generation, ts_proc)",
}
_RAW = {"sales": RAW_SALES, "products": RAW_PRODUCTS}


def _keyed(subject: str) -> str:
    return f"select {_KEY[subject]} as dedup_key, * from ({_RAW[subject]})"


def _profile(subject: str) -> str:
    return f"""select dedup_key, cast(count(*) as bigint) as qtd_registros
    from ({_keyed(subject)}) group by dedup_key"""


def _newest(subject: str) -> str:
    return f"select max(dedup_key) as max_dedup_key from ({_keyed(subject)})"


def _latest(subject: str) -> str:
    return f"""select a.* from ({_keyed(subject)}) a
    join ({_newest(subject)}) m on a.dedup_key = m.max_dedup_key"""


def _lookback(rows: str, days: int | None) -> str:
    if days is None:
        return rows
    first = f"strftime({AS_OF} - interval {days} day, '%Y%m%d')"
    return f"select * from ({rows}) where ref >= {first}"


def _aged(rows: str) -> str:
    """Adds ``age``: whole months to the run date; dates after it count as 0."""
    return f"""
    select * exclude (d, months),
           case when months > 0 and day({AS_OF}) < day(d)
                     and not ({AS_OF} = last_day({AS_OF}) and d = last_day(d))
                then months - 1 else greatest(months, 0) end as age
    from (select *, (year({AS_OF}) - year(d)) * 12 + month({AS_OF}) - month(d) as months
          from (select *, cast(strptime(ref, '%Y%m%d') as date) as d from ({rows})))
    """


def _enriched(sales: str, products: str) -> str:
    return f"""select s.*, p.product_category from ({sales}) s
    left join ({products}) p on s.product_id = p.product_id"""


def _feature(feature: Feature) -> str:
    condition = f"{feature.dimension.column} = '{feature.value}'"
    if feature.window.months is not None:
        condition += f" and age <= {feature.window.months}"
    amount = f"case when {condition} then amount end"
    cents = f"sum(case when {condition} then cast(amount * 100 as bigint) end)"
    # Half-up division in whole numbers; amounts here are positive.
    millionths = f"(20000 * {cents} + count({amount})) // (2 * count({amount}))"
    form = {
        "qtd": f"cast(sum(case when {condition} then 1 end) as bigint)",
        "sum": f"cast(sum({amount}) as decimal(24,2))",
        "avg": f"cast(cast({millionths} as decimal(18,0)) * 0.000001 as decimal(18,6))",
        "min": f"min({amount})",
        "max": f"max({amount})",
    }[feature.statistic]
    return f"{form} as {feature.name}"


def _book(
    spec: FeatureSpec = BOOK,
    days: int | None = None,
    sales: str = SALES,
    products: str = PRODUCTS,
) -> str:
    features = ",\n           ".join(_feature(f) for f in spec.features())
    rows = _aged(_enriched(_lookback(sales, days), products))
    return f"""
    select user_id,
           '{b.AS_OF:%Y%m%d}' as ref,
           '{b.TS_BOOK}' as ts_proc,
           {features}
    from ({rows}) group by user_id
    """


_SALES_BY_SIZE = f"""select * replace (cast(quantity as varchar) as product_id) from ({SALES})"""
_PARTS_BY_SIZE = f"""select cast(p_size as varchar) as product_id,
    {_case("p_type", b.CATEGORIES)} as product_category from part"""
_SUPPLIERS = "select cast(s_suppkey as varchar) as product_id, s_name as product_category"

_LANDED_SALES = f"""
    select cast(transaction_id as varchar) as transaction_id,
           cast(user_id as varchar) as user_id,
           cast(product_id as varchar) as product_id,
           cast(dat_creation as varchar) as dat_creation,
           cast(amount as varchar) as amount,
           cast(quantity as varchar) as quantity,
           payment_method,
           status
    from ({SALES_SOURCE})
"""

_SALES_FILES = f"""
    select 'sales_{b.FILE_JUL[:8]}_{b.FILE_JUL}.csv' as filename, '{b.FILE_JUL[:8]}' as ref,
           '{b.FILE_JUL}' as ts_file_generation
    from ({SALES_SOURCE}) where dat_creation < {JULY}
    union all
    select 'sales_{b.FILE_AUG[:8]}_{b.FILE_AUG}.csv', '{b.FILE_AUG[:8]}', '{b.FILE_AUG}'
    from ({SALES_SOURCE})
"""

_SALES_INCREMENTS = f"""
    select ref, '{b.RUN_JUL}' as ts_proc, '{b.FILE_JUL}' as ts_file_generation, {_SALES_BODY}
    from ({SALES}) where dat_creation < {JULY}
    union all select * from ({SALES})
"""


def _control(subject: str, batch: str, ts_proc: str) -> str:
    """The row names the latest ``ref`` of the newest file."""
    return f"""
    select '{subject}' as assunto,
           (select max(ref) from ({batch}) where ts_file_generation =
                (select max(ts_file_generation) from ({batch}))) as ref,
           max(ts_file_generation) as ts_file_generation,
           cast({ts_proc} as bigint) as ts_proc,
           cast(count(*) as bigint) as qtd_registros
    from ({batch}) having count(*) > 0
    """


def _book_control(spec_days: int) -> str:
    return f"""
    select '{BOOK_SUBJECT}' as assunto, cast({b.AS_OF:%Y%m%d} as integer) as ref,
           cast({b.TS_BOOK} as bigint) as ts_proc,
           cast(count(distinct user_id) as bigint) as qtd_registros
    from ({_lookback(SALES, spec_days)})
    """


_RUN_JULY = f"select * from ({RAW_SALES}) where ts_proc = '{b.RUN_JUL}'"
_RUN_AUGUST = f"select * from ({RAW_SALES}) where ts_proc = '{b.RUN_AUG}'"
_INCREMENT_JULY = f"select * from ({_SALES_INCREMENTS}) where ts_proc = '{b.RUN_JUL}'"
_ORDER = "assunto, ref, ts_file_generation, ts_proc, qtd_registros"

ORACLES: dict[str, str] = {
    "landing_csv_roundtrip": f"""
        select cast(p_partkey as varchar) as proudct_id, p_name as product_des,
               {_case("p_type", b.CATEGORIES)} as product_category, p_brand as brand
        from part
    """,
    "landing_text_roundtrip": """
        select cast(doc_id as varchar) as doc_id, text, lang, source,
               cast(n_chars as varchar) as n_chars
        from documents
    """,
    "landing_glob_scan": f"""
        select * from ({_LANDED_SALES})
        union all
        select * from ({_LANDED_SALES}) where cast(dat_creation as timestamp) < {JULY}
    """,
    "file_lineage": f"""
        select filename, ref, ts_file_generation, '{b.RUN_AUG}' as ts_proc,
               cast(count(*) as bigint) as qtd_registros
        from ({_SALES_FILES}) group by all
    """,
    "landing_increment": _SALES_INCREMENTS,
    "increment_ledger": f"""
        select {_ORDER} from ({_control("sales", _INCREMENT_JULY, b.RUN_JUL)})
        union all select {_ORDER} from ({_control("sales", SALES, b.RUN_AUG)})
    """,
    "rerun_replaced": SALES,
    "conform_products": PRODUCTS,
    "conform_users": USERS,
    "conform_sales": SALES,
    "conform_malformed": f"""
        select case when o_orderstatus = 'P' then replace(substr(o_orderpriority, 1, 10), '-', '')
                    else strftime(o_orderdate, '%Y%m%d') end as ref,
               '{b.RUN_AUG}' as ts_proc,
               '{b.FILE_AUG}' as ts_file_generation,
               cast(o_orderkey as varchar) as transaction_id,
               cast(o_custkey as varchar) as user_id,
               cast(null as varchar) as product_id,
               case when o_orderstatus <> 'P' then o_orderdate end as dat_creation,
               case when o_orderstatus <> 'F' then cast(o_totalprice as decimal(14,2)) end
                   as amount,
               case when o_orderstatus = 'O' then cast(o_custkey as integer) end as quantity,
               o_orderpriority as payment_method
        from orders
    """,
    "raw_append_readback": SALES,
    "version_key_sales": _keyed("sales"),
    "batch_profile_sales": _profile("sales"),
    "batch_profile_products": _profile("products"),
    "newest_version_sales": _newest("sales"),
    "newest_version_products": _newest("products"),
    "latest_batch_sales": _latest("sales"),
    "latest_run_batch_sales": _latest("sales"),
    "latest_batch_products": _latest("products"),
    "lookback_filter": _lookback(RAW_SALES, 180),
    "recency_flags": f"""
        select transaction_id, user_id, ref, product_category, dat_creation, amount,
               payment_method,
               case when age <= 1 then 1 else 0 end as flag_u1m,
               case when age <= 3 then 1 else 0 end as flag_u3m,
               case when age <= 6 then 1 else 0 end as flag_u6m
        from ({_aged(_enriched(SALES, PRODUCTS))})
    """,
    "enrich_category": _enriched(SALES, PRODUCTS),
    "enrich_fanout": _enriched(_SALES_BY_SIZE, f"select distinct * from ({_PARTS_BY_SIZE})"),
    "enrich_unmatched": _enriched(SALES, f"{_SUPPLIERS} from supplier"),
    "cond_count": _book(BOOK.only(statistics=("qtd",))),
    "cond_sum": _book(BOOK.only(statistics=("sum",))),
    "cond_avg": _book(BOOK.only(statistics=("avg",))),
    "cond_min": _book(BOOK.only(statistics=("min",))),
    "cond_max": _book(BOOK.only(statistics=("max",))),
    "feature_book_pcat": _book(BOOK.only(dimensions=("pcat",))),
    "feature_book_pm": _book(BOOK.only(dimensions=("pm",))),
    "feature_book": _book(days=180),
    "feature_book_direct": _book(days=180),
    "feature_book_full_history": _book(),
    "feature_book_fanout": _book(sales=_SALES_BY_SIZE, products=_PARTS_BY_SIZE),
    "feature_book_from_increments": _book(days=180),
    "row_count": f"select cast(count(*) as bigint) as qtd_registros from ({RAW_SALES})",
    "control_batch_sales": _control("sales", _RUN_AUGUST, b.RUN_AUG),
    "control_batch_products": _control("products", PRODUCTS, b.RUN_AUG),
    "control_batch_users": _control("users", USERS, b.RUN_AUG),
    "control_book": _book_control(180),
    "curated_publish_readback": _book(days=180),
    "users_publish_readback": USERS,
    "control_ledger": f"""
        select {_ORDER} from ({_control("sales", _RUN_JULY, b.RUN_JUL)})
        union all select {_ORDER} from ({_control("sales", _RUN_AUGUST, b.RUN_AUG)})
        union all select {_ORDER} from ({_control("products", PRODUCTS, b.RUN_AUG)})
        union all select {_ORDER} from ({_control("users", USERS, b.RUN_AUG)})
        union all select assunto, cast(ref as varchar), cast(null as varchar), ts_proc,
                         qtd_registros from ({_book_control(180)})
    """,
}

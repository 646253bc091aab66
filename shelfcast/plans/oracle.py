"""DuckDB SQL for the registered queries, written from the semantics and, where possible, in another shape."""

from __future__ import annotations

import re
from itertools import combinations, permutations

from shelfcast.plans.catalog import ENCODED
from shelfcast.sources import binding as b

T = b.TARGET_MONTH
REMAP = "CASE {c} WHEN 0 THEN 20 WHEN 1 THEN 21 WHEN 11 THEN 10 ELSE {c} END"
NOT_NAME = "[^A-Za-z0-9А-Яа-я]+"
_TOKEN2 = "nullif(split_part(shop_name, ' ', 2), '')"

# Named building blocks; a query lists the ones it uses by mentioning their names.
CTES: dict[str, str] = {
    "sales": """
        SELECT CAST(l_shipdate AS DATE) AS date,
               CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS INTEGER) AS month_id,
               s_nationkey AS shop_id, l_partkey AS item_id,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS item_price,
               CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS item_quantity
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "shops": """
        SELECT n_nationkey AS shop_id, r_name || ' ' || n_name AS shop_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "items": """
        SELECT p_partkey AS item_id,
               p_name || CASE WHEN p_size > 10 THEN ' [' || p_type || ']' ELSE '' END || ' (' || p_brand || ')' AS item_name,
               CAST(substr(p_brand, 7) AS INTEGER) AS item_category_id
        FROM part""",
    "categories": """
        SELECT CAST(substr(p_brand, 7) AS INTEGER) AS item_category_id,
               arg_min(p_type, p_partkey) || ' - ' || arg_min(p_name, p_partkey) AS item_category_name
        FROM part GROUP BY p_brand""",
    "test": f"""
        SELECT DISTINCT CAST({REMAP.format(c='c_nationkey')} AS BIGINT) * 1000000000 + l_partkey AS "ID",
               {REMAP.format(c='c_nationkey')} AS shop_id, l_partkey AS item_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "cleaned": f"""
        SELECT date, month_id, {REMAP.format(c='shop_id')} AS shop_id, item_id, item_price,
               greatest(item_quantity, 0) AS item_quantity
        FROM sales WHERE item_quantity <= 1000 AND item_price <= 100000 AND item_price >= 0""",
    "monthly": """
        SELECT month_id, shop_id, item_id, sum(item_quantity) AS item_quantity FROM cleaned GROUP BY ALL""",
    "grid": """
        SELECT month_id, s.shop_id, i.item_id
        FROM (SELECT DISTINCT month_id, shop_id FROM cleaned) s
        JOIN (SELECT DISTINCT month_id, item_id FROM cleaned) i USING (month_id)""",
    "dense": """
        SELECT month_id, shop_id, item_id, coalesce(item_quantity, 0) AS item_quantity
        FROM grid LEFT JOIN monthly USING (month_id, shop_id, item_id)""",
    "panel": f"""
        SELECT month_id, shop_id, item_id, item_quantity FROM dense
        UNION ALL SELECT {T}, shop_id, item_id, 0 FROM test""",
    # Attributes: words, rare values folded, codes by rank among distinct values.
    "shop_words": f"SELECT shop_id, split_part(shop_name, ' ', 1) AS city, {_TOKEN2} AS kind0 FROM shops",
    "shop_kinds": """
        SELECT shop_id, city, CASE WHEN count(*) OVER (PARTITION BY kind0) > 4 THEN kind0 ELSE 'etc' END AS kind
        FROM shop_words""",
    "shop_dim": """
        SELECT shop_id, CAST(dense_rank() OVER (ORDER BY kind) - 1 AS INTEGER) AS shop_type_code,
               CAST(dense_rank() OVER (ORDER BY city) - 1 AS INTEGER) AS city_code FROM shop_kinds""",
    "cat_words": """
        SELECT item_category_id, split_part(item_category_name, ' ', 1) AS kind0,
               trim(split_part(item_category_name, '-', 2)) AS sub FROM categories""",
    "cat_kinds": """
        SELECT item_category_id, sub, CASE WHEN count(*) OVER (PARTITION BY kind0) > 4 THEN kind0 ELSE 'etc' END AS kind
        FROM cat_words""",
    "cat_dim": """
        SELECT item_category_id, CAST(dense_rank() OVER (ORDER BY sub) - 1 AS INTEGER) AS category_subtype_code,
               CAST(dense_rank() OVER (ORDER BY kind) - 1 AS INTEGER) AS category_type_code FROM cat_kinds""",
    "item_raw": f"""
        SELECT item_id, item_category_id, item_name,
               CASE WHEN strpos(item_name, '[') > 0
                    THEN lower(regexp_replace(substr(item_name, strpos(item_name, '[') + 1), '{NOT_NAME}', ' ', 'g'))
                    ELSE '0' END AS n2,
               CASE WHEN strpos(item_name, '(') > 0
                    THEN lower(regexp_replace(substr(item_name, strpos(item_name, '(') + 1), '{NOT_NAME}', ' ', 'g'))
                    ELSE '0' END AS name3
        FROM items""",
    "item_cut": """
        SELECT item_id, item_category_id, name3,
               CASE WHEN n2 = '0' THEN n2 ELSE left(n2, length(n2) - 1) END AS name2 FROM item_raw""",
    "item_typed": """
        SELECT *, CASE WHEN k = 'xbox' THEN replace(left(name2, 8), ' ', '') WHEN k = 'x360' THEN 'xbox360'
                       WHEN k = '' THEN 'mac' WHEN k = 'pс' THEN 'pc' WHEN k = 'рs3' THEN 'ps3' ELSE k END AS type
        FROM (SELECT *, split_part(name2, ' ', 1) AS k FROM item_cut)""",
    "item_parts": """
        SELECT item_id, item_category_id, CASE WHEN name2 IN (
                 SELECT type FROM item_typed GROUP BY type HAVING count(*) < 40) THEN 'etc' ELSE name2 END AS name2, name3
        FROM item_typed""",
    "item_dim": """
        SELECT item_id, item_category_id, CAST(dense_rank() OVER (ORDER BY name2) - 1 AS INTEGER) AS name2,
               CAST(dense_rank() OVER (ORDER BY name3) - 1 AS INTEGER) AS name3 FROM item_parts""",
    "group_words": f"""
        SELECT item_category_id, item_category_name, split_part(item_category_name, ' - ', 1) AS grp,
               split_part(item_category_name, ' ', 4) AS noun, item_category_name LIKE '%{b.DIGITAL_MARKER}%' AS digital
        FROM categories""",
    "long_cat_dim": """
        SELECT item_category_id, digital AS item_category_is_digital,
               CASE grp WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'PROMO' THEN 3
                        WHEN 'SMALL' THEN 4 END AS item_supercategory_id,
               list_position(['anvil','bolt','gear','gizmo','plate','ring','rod','widget'], noun) - 1 AS item_category_console_id
        FROM group_words WHERE item_category_id NOT IN (8, 18)""",
    "rich": """
        SELECT month_id, shop_id, item_id, item_quantity, shop_type_code, city_code, item_category_id, name2, name3,
               category_subtype_code, category_type_code, item_supercategory_id, item_category_console_id
        FROM panel LEFT JOIN shop_dim USING (shop_id) LEFT JOIN item_dim USING (item_id)
        LEFT JOIN cat_dim USING (item_category_id) LEFT JOIN long_cat_dim USING (item_category_id)""",
    # Price and revenue.
    "price_item": """
        SELECT item_id, CAST(sum(item_price) AS DOUBLE) / count(item_price) AS item_avg_item_price
        FROM cleaned GROUP BY item_id""",
    "price_month_item": """
        SELECT month_id, item_id, CAST(sum(item_price) AS DOUBLE) / count(item_price) AS item_monthly_avg_item_price
        FROM cleaned GROUP BY ALL""",
    "revenue": """
        SELECT month_id, shop_id, sum(item_price * CAST(item_quantity AS BIGINT)) AS rev FROM cleaned GROUP BY ALL""",
    "avg_revenue": "SELECT shop_id, CAST(sum(rev) AS DOUBLE) / count(*) AS avg_rev FROM revenue GROUP BY shop_id",
    "price_delta": """
        SELECT p.month_id, p.item_id, CASE WHEN item_avg_item_price <> 0 THEN
               (item_monthly_avg_item_price - item_avg_item_price) / item_avg_item_price END AS delta
        FROM price_month_item p JOIN price_item USING (item_id)""",
    # Linear recipe.
    "categorised": "SELECT s.*, item_category_id FROM sales s LEFT JOIN items USING (item_id) WHERE item_price > 0",
    "priced": """
        SELECT month_id, item_category_id, shop_id, item_id, CAST(sum(item_price) AS DOUBLE) / count(*) AS item_price,
               sum(item_quantity) AS item_cnt_month FROM categorised GROUP BY ALL""",
    "pairs": """
        SELECT shop_id, item_id, avg(item_price) AS item_price_mean, avg(item_cnt_month) AS item_cnt_month
        FROM priced GROUP BY ALL""",
    "cat_price": """
        SELECT item_category_id, avg(p) AS item_cat_price_mean
        FROM (SELECT item_category_id, item_id, CAST(sum(item_price) AS DOUBLE) / count(*) AS p
              FROM categorised GROUP BY ALL) GROUP BY item_category_id""",
    "context": """
        SELECT t."ID", t.shop_id, t.item_id, i.item_category_id, item_price_mean, item_cat_price_mean
        FROM test t LEFT JOIN pairs p ON p.shop_id = t.shop_id AND p.item_id = t.item_id
        LEFT JOIN items i ON i.item_id = t.item_id LEFT JOIN cat_price c ON c.item_category_id = i.item_category_id""",
    "senior": """
        SELECT p.month_id, p.shop_id, p.item_id, p.item_quantity,
               2 - (p.month_id = f.m)::INT - (NOT coalesce(p.month_id - s.m > 0, false))::INT AS item_seniority
        FROM panel p JOIN (SELECT item_id, min(month_id) AS m FROM panel GROUP BY item_id) f USING (item_id)
        LEFT JOIN (SELECT shop_id, item_id, min(month_id) AS m FROM monthly GROUP BY ALL) s
               ON s.shop_id = p.shop_id AND s.item_id = p.item_id""",
    "recent12": f"""
        SELECT shop_id, item_id, least(greatest(sum(item_quantity) / 12, 0), 20) AS y FROM monthly
        WHERE month_id >= {T - 12} GROUP BY ALL""",
    "recent24": f"""
        SELECT shop_id, item_id, least(greatest(sum(item_quantity) / 24, 0), 20) AS y FROM monthly
        WHERE month_id >= {T - 24} GROUP BY ALL""",
}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a query with the building blocks it mentions, directly or through another block."""
    blocks = {**CTES, **(extra or {})}
    wanted: list[str] = []

    def visit(sql: str, seen: tuple[str, ...]) -> None:
        for name in blocks:
            if name in wanted or name in seen:
                continue
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                visit(blocks[name], (*seen, name))
                wanted.append(name)

    visit(body, ())
    if not wanted:
        return body
    heads = ",\n".join(f"{n} AS MATERIALIZED ({blocks[n]})" for n in wanted)
    return f"WITH {heads}\n{body}"


ALL_SALES = "date, month_id, shop_id, item_id, CAST(item_price AS DOUBLE) AS item_price, item_quantity"


def months_back(col: str, k: int) -> str:
    """``col`` of the pair's own row k months earlier, NULL without such a row; (month, shop, item) must be unique."""
    return f"max({col}) OVER (PARTITION BY shop_id, item_id ORDER BY month_id RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING)"


def lag_sql(src: str, lags: list[int]) -> str:
    picks = ", ".join(f"{months_back('item_quantity', k)} AS item_quantity_lag_{k}" for k in lags)
    return f"SELECT month_id, shop_id, item_id, item_quantity, {picks} FROM {src}"


# Lagged group means: the pair must exist k months earlier, then its group's mean is read there.
def lagged_mean_sql(keys: tuple[str, ...], lags: tuple[int, ...]) -> str:
    cols = ["month_id", *keys]
    on = " AND ".join(f"g.{c} = r.{c}" for c in cols)
    means = f"SELECT {', '.join(cols)}, sum(item_quantity) / count(*) AS m FROM rich GROUP BY ALL"
    held = f"SELECT r.month_id, r.shop_id, r.item_id, g.m AS m FROM rich r LEFT JOIN ({means}) g ON {on}"
    picks = ", ".join(f"{months_back('m', k)} AS mean_q_lag_{k}" for k in lags)
    return with_ctes(f"SELECT month_id, shop_id, item_id, {picks} FROM held", {"held": held})


def mean_sql(keys: tuple[str, ...]) -> str:
    cols = ", ".join(["month_id", *keys])
    return with_ctes(f"SELECT {cols}, sum(item_quantity) / count(*) AS mean_q FROM rich GROUP BY ALL")


def walk_sql(ks: list[int]) -> str:
    arms = " ".join(f"WHEN d{k} IS NULL THEN 0 WHEN d{k} <> 0 THEN d{k}" for k in ks)
    return f"CASE {arms} ELSE 0 END"


def delta_rows(ks: list[int]) -> str:
    """Price deltas per panel row, read through the pair's row k months earlier."""
    picks = ", ".join(f"{months_back('delta', k)} AS d{k}" for k in ks)
    return f"SELECT month_id, shop_id, item_id, {picks} FROM panel LEFT JOIN price_delta USING (month_id, item_id)"


def describe_sql(source: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, "
        f"min(x) AS min, round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50, "
        f"round(quantile_cont(x, 0.75), 6) AS q75, max(x) AS max FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {source})"
        for c in cols
    )


# -- whole feature tables: plain joins over the dense panel, in the order the recipe describes them ---------------


def features_sql(
    encodings,
    lags: tuple[int, ...],
    *,
    attrs: str,
    price_lags: list[int],
    revenue: bool,
    fill: tuple[str, ...],
    clip_end: bool,
    burn_in: int,
    days: str,
    senior: bool = False,
    extra: dict[str, str] | None = None,
) -> str:
    held_cols = ["item_quantity"]
    mean_joins, blocks = [], dict(extra or {})
    for n, e in enumerate(encodings):
        cols = ["month_id", *e.keys]
        blocks[f"enc{n}"] = f"SELECT {', '.join(cols)}, sum(item_quantity) / count(*) AS {e.name} FROM rich GROUP BY ALL"
        mean_joins.append(f"LEFT JOIN enc{n} ON " + " AND ".join(f"enc{n}.{c} = r.{c}" for c in cols))
        held_cols.append(e.name)
    held = "SELECT r.*, " + ", ".join(e.name for e in encodings)
    if price_lags:
        held += ", delta AS price_delta"
        mean_joins.append("LEFT JOIN price_delta pd ON pd.month_id = r.month_id AND pd.item_id = r.item_id")
    if revenue:
        held += ", (CAST(rev AS DOUBLE) - avg_rev) / avg_rev AS delta_revenue"
        mean_joins.append(
            "LEFT JOIN revenue ON revenue.month_id = r.month_id AND revenue.shop_id = r.shop_id "
            "LEFT JOIN avg_revenue ON avg_revenue.shop_id = r.shop_id"
        )
    blocks["held"] = f"{held} FROM rich r {' '.join(mean_joins)}"
    stems = [("item_quantity", lags), *[(e.name, e.lags) for e in encodings]]
    if revenue:
        stems.append(("delta_revenue", (1,)))
    back = [(stem, k) for stem, ks in stems for k in ks] + [("price_delta", k) for k in price_lags]
    blocks["lagged_held"] = "SELECT *, " + ", ".join(f"{months_back(c, k)} AS {c}_back_{k}" for c, k in back) + " FROM held"

    def shown(expr: str, name: str) -> str:
        if "_lag_" in name and any(p in name for p in fill):
            expr = f"coalesce({expr}, 0)"
        if clip_end and "item_quantity" in name:
            expr = f"least(greatest({expr}, 0), 20)"
        return f"{expr} AS {name}"

    picks = [shown("p.item_quantity", "item_quantity")]
    picks += [shown(f"p.{stem}_back_{k}", f"{stem}_lag_{k}") for stem, ks in stems for k in ks]
    if price_lags:
        arms = " ".join(
            f"WHEN p.price_delta_back_{k} IS NULL THEN 0 WHEN p.price_delta_back_{k} <> 0 THEN p.price_delta_back_{k}"
            for k in price_lags
        )
        picks.append(f"CASE {arms} ELSE 0 END AS delta_price_lag")
    if senior:
        blocks["senior_rows"] = "SELECT month_id, shop_id, item_id, item_seniority FROM senior"
        picks.append("s.item_seniority")
    joins = ""
    if senior:
        joins += " JOIN senior_rows s ON s.month_id = p.month_id AND s.shop_id = p.shop_id AND s.item_id = p.item_id"
    blocks["firsts"] = "SELECT shop_id, item_id, min(month_id) AS pm FROM panel GROUP BY ALL"
    blocks["item_firsts"] = "SELECT item_id, min(month_id) AS im FROM panel GROUP BY ALL"
    body = f"""SELECT p.month_id, p.shop_id, p.item_id, {attrs}, {', '.join(picks)},
        p.month_id % 12 AS month,
        [31,28,31,30,31,30,31,31,30,31,30,31][p.month_id % 12 + 1] AS {days},
        p.month_id - pm AS item_shop_first_sale, p.month_id - im AS item_first_sale
        FROM lagged_held p {joins}
        JOIN firsts f ON f.shop_id = p.shop_id AND f.item_id = p.item_id
        JOIN item_firsts g ON g.item_id = p.item_id WHERE p.month_id > {burn_in}"""
    return with_ctes(body, blocks)


def digest_sql(table_sql: str, cols: list[str]) -> str:
    parts = ", ".join(
        f"count({c}) AS n_{c}, CAST(sum(CAST(floor(CAST({c} AS DOUBLE) * 1000000) AS BIGINT)) AS BIGINT) AS s_{c}"
        for c in cols
    )
    return f"SELECT month_id, shop_id, count(*) AS n_rows, {parts} FROM ({table_sql}) GROUP BY ALL"


SHORT_ATTRS = ["shop_type_code", "city_code", "item_category_id", "name2", "name3", "category_subtype_code", "category_type_code"]
LONG_ATTRS = ["city_id", "item_category_id", "item_category_is_digital", "item_supercategory_id", "item_category_console_id"]
# The early-clip recipe bounds the filled panel before the rows to predict are appended.
EARLY_BLOCKS = {
    "dense": """
        SELECT month_id, shop_id, item_id, least(greatest(coalesce(item_quantity, 0), 0), 20) AS item_quantity
        FROM grid LEFT JOIN monthly USING (month_id, shop_id, item_id)"""
}
_kept = "shop_id NOT IN (9, 20)"
LONG_BLOCKS = {
    "test": f"""
        SELECT DISTINCT shop_id, item_id FROM (
            SELECT {REMAP.format(c='c_nationkey')} AS shop_id, l_partkey AS item_id
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
        WHERE {_kept} AND item_id NOT IN (SELECT item_id FROM items WHERE item_category_id IN (8, 18))""",
    "merged": f"""
        SELECT date, month_id, shop_id, item_id, item_price, sum(item_quantity) AS item_quantity FROM (
            SELECT date, month_id, {REMAP.format(c='shop_id')} AS shop_id, item_id, item_price, item_quantity
            FROM sales WHERE item_quantity >= 0)
        WHERE {_kept} AND NOT (shop_id = 14 AND month_id = 18)
          AND item_id NOT IN (SELECT item_id FROM items WHERE item_category_id IN (8, 18)) GROUP BY ALL""",
    "cleaned": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (ORDER BY item_price, date, month_id, shop_id, item_id, item_quantity) AS rn
            FROM merged) WHERE rn > 1""",
    "monthly": """
        SELECT month_id, shop_id, item_id, least(greatest(sum(item_quantity), 0), 20) AS item_quantity
        FROM cleaned GROUP BY ALL""",
    "long_shops": """
        SELECT shop_id, min(shop_id) OVER (PARTITION BY split_part(shop_name, ' ', 1)) AS f
        FROM shops WHERE shop_id NOT IN (0, 1, 11)""",
    "long_shop_dim": f"SELECT shop_id, city_id FROM (SELECT shop_id, dense_rank() OVER (ORDER BY f) - 1 AS city_id FROM long_shops) WHERE {_kept}",
    "rich": """
        SELECT month_id, shop_id, item_id, item_quantity, city_id, item_category_id, item_category_is_digital,
               item_supercategory_id, item_category_console_id
        FROM panel LEFT JOIN long_shop_dim USING (shop_id) LEFT JOIN items USING (item_id)
        LEFT JOIN long_cat_dim USING (item_category_id)""",
}


def _feature_columns(variant, attrs: list[str]) -> list[str]:
    cols = ["item_id", *attrs, "item_quantity", *[f"item_quantity_lag_{k}" for k in variant.target_lags]]
    cols += [f"{e.name}_lag_{k}" for e in variant.encodings for k in e.lags]
    cols += ["delta_price_lag"] if variant.price_trend else []
    cols += ["delta_revenue_lag_1"] if variant.revenue_trend else []
    cols += ["month", variant.days_name, "item_shop_first_sale", "item_first_sale"]
    return cols + (["item_seniority"] if variant.seniority else [])


def feature_rows_sql(variant) -> str:
    """Row-level feature table of a variant."""
    long = variant.name == "long_lag"
    attrs = LONG_ATTRS if long else SHORT_ATTRS
    blocks = LONG_BLOCKS if long else EARLY_BLOCKS if variant.clip_at == "panel" else None
    return features_sql(
        variant.encodings,
        variant.target_lags,
        attrs=", ".join(f"p.{a}" for a in attrs),
        price_lags=list(variant.price_lags) if variant.price_trend else [],
        revenue=variant.revenue_trend,
        fill=variant.fill_patterns,
        clip_end=variant.clip_at == "end",
        burn_in=variant.burn_in,
        days=variant.days_name,
        senior=variant.seniority,
        extra=blocks,
    )


def feature_digest_sql(variant) -> str:
    attrs = LONG_ATTRS if variant.name == "long_lag" else SHORT_ATTRS
    return digest_sql(feature_rows_sql(variant), _feature_columns(variant, attrs))


_SUB = "trim(CASE WHEN strpos(name, '-') > 0 THEN split_part(name, '-', 2) ELSE name END)"
_CONSOLE = " || ".join(
    f"CASE WHEN strpos(item_name, '{n}') > 0 THEN '{n}' ELSE '' END"
    for n in (*b.NOUNS, "PS2", "PS3", "PS4", "PSP", "PSVita", "XBOX 360", "XBOX ONE", "PC", "MAC", "Android")
)
_SCORE = "substr(md5('0-' || month_id || '-' || item_category_id || '-' || shop_id || '-' || item_id), 1, 12)"
_LINEAR = ["month_id", "item_category_id", "shop_id", "item_id", "item_price"]
_GRAM = ", ".join(
    [f"sum({p} * {q}) AS x{i}x{j}" for i, p in enumerate("abcde") for j, q in enumerate("abcde") if i <= j]
    + [f"sum({p} * y) AS x{i}y" for i, p in enumerate("abcde")]
)



def _determinant(columns: list[list[str]]) -> str:
    """Leibniz' sum over permutations; ``columns[j][i]`` is the entry in row i and column j."""
    terms = []
    for order in permutations(range(len(columns))):
        odd = sum(a > b for a, b in combinations(order, 2)) % 2
        terms.append(("-" if odd else "+") + " * ".join(columns[j][i] for j, i in enumerate(order)))
    return "(" + " ".join(terms) + ")"


def solved_sql(lam: float) -> str:
    """Weights of the training rows by Cramer's rule on the Gram matrix, with ``lam`` on its diagonal."""
    n = len(_LINEAR)
    entry = [[f"x{min(i, j)}x{max(i, j)}" for i in range(n)] for j in range(n)]
    matrix = [[f"({e} + {lam})" if i == j else e for i, e in enumerate(col)] for j, col in enumerate(entry)]
    right = [f"x{i}y" for i in range(n)]
    whole = _determinant(matrix)
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round({_determinant([*matrix[:j], right, *matrix[j + 1 :]])} / {whole}, 6) AS weight FROM trained_gram"
        for j, f in enumerate(_LINEAR)
    )


_BODIES: dict[str, str] = {
    "conform_sales": f"SELECT strftime(date, '%d.%m.%Y') AS date, * EXCLUDE (date) FROM (SELECT {ALL_SALES} FROM sales)",
    "drop_outliers": f"SELECT {ALL_SALES} FROM sales WHERE item_quantity <= 1000 AND item_price <= 100000",
    "drop_negative_price": f"SELECT {ALL_SALES} FROM sales WHERE NOT item_price < 0",
    "keep_positive_price": f"SELECT {ALL_SALES} FROM sales WHERE item_price > 0",
    "returns_to_zero": "SELECT date, month_id, shop_id, item_id, CAST(item_price AS DOUBLE) AS item_price, greatest(item_quantity, 0) AS item_quantity FROM sales",
    "returns_drop": f"SELECT {ALL_SALES} FROM sales WHERE item_quantity >= 0",
    "drop_keys": f"SELECT {ALL_SALES} FROM sales WHERE shop_id NOT IN (9, 20) AND item_id NOT IN (SELECT p_partkey FROM part WHERE p_brand IN ('Brand#8', 'Brand#18'))",
    "drop_composite": f"SELECT {ALL_SALES} FROM sales WHERE shop_id <> 14 OR month_id <> 18",
    "drop_argmin": f"SELECT * EXCLUDE (rn) FROM (SELECT {ALL_SALES}, row_number() OVER (ORDER BY sales.item_price, date, month_id, shop_id, item_id, item_quantity) AS rn FROM sales) WHERE rn > 1",
    "remap_keys": "SELECT date, month_id, CASE shop_id WHEN 0 THEN 57 WHEN 1 THEN 58 WHEN 11 THEN 10 WHEN 40 THEN 39 ELSE shop_id END AS shop_id, item_id, CAST(item_price AS DOUBLE) AS item_price, item_quantity FROM sales",
    "patch_names": "SELECT item_category_id, coalesce(n, item_category_name) AS item_category_name FROM categories LEFT JOIN (VALUES (1, 'Misc - one'), (8, 'Misc - eight'), (20, 'Misc - twenty')) v(k, n) ON k = item_category_id",
    "consolidate_duplicates": "SELECT date, month_id, shop_id, item_id, CAST(item_price AS DOUBLE) AS item_price, sum(item_quantity) AS item_quantity FROM sales GROUP BY ALL",
    "parse_date": "SELECT date, count(*) AS n FROM sales GROUP BY date",
    "day_id": "SELECT date, count(*) AS n, CAST(date_diff('day', (SELECT min(date) FROM sales), date) AS INTEGER) AS day_id FROM sales GROUP BY date",
    "narrow_schema": f"SELECT {ALL_SALES} FROM sales",
    "panel_monthly_sales": lag_sql("dense", [1, 2, 3]),
    "monthly_sales": "SELECT month_id, shop_id, item_id, item_quantity FROM monthly",
    "active_grid": "SELECT month_id, shop_id, item_id FROM grid",
    "grid_fill_zero": "SELECT month_id, shop_id, item_id, item_quantity FROM dense",
    "union_test_keys": "SELECT month_id, shop_id, item_id, item_quantity FROM panel",
    "lag_selfjoin": lag_sql("dense", [1, 2, 3]),
    "lag_range": lag_sql("panel", [1, 2, 3, 6, 12]),
    "burn_in": f"SELECT * FROM ({lag_sql('dense', [1])}) WHERE month_id > 2",
    "fill_lags": "SELECT month_id, shop_id, item_id, item_quantity, CAST(1 AS DOUBLE) AS presence, "
    + f"coalesce({months_back('item_quantity', 1)}, 0) AS item_quantity_lag_1, {months_back('CAST(1 AS DOUBLE)', 1)} AS presence_lag_1 FROM dense",
    "clip_target": "SELECT month_id, shop_id, item_id, least(item_quantity, 20) AS item_quantity, "
    + f"{months_back('least(item_quantity, 20)', 1)} AS item_quantity_lag_1 FROM dense",
    "attach_dims": "SELECT month_id, shop_id, item_id, item_quantity, shop_type_code, city_code, item_category_id, name2, name3, category_subtype_code, category_type_code FROM rich",
    "denormalise": f"SELECT {ALL_SALES.replace('shop_id', 's.shop_id').replace('item_id', 's.item_id')}, shop_name, item_name, i.item_category_id, item_category_name FROM sales s LEFT JOIN shops h ON h.shop_id = s.shop_id LEFT JOIN items i ON i.item_id = s.item_id LEFT JOIN categories c ON c.item_category_id = i.item_category_id",
    "localise_names": "SELECT n_nationkey AS shop_id, CASE WHEN n_regionkey < 3 THEN lower(n_name) ELSE r_name || ' ' || n_name END AS shop_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "lookup_category": "SELECT i.item_category_id, c.item_category_name, count(*) AS n, sum(item_quantity) AS units FROM sales s LEFT JOIN items i ON i.item_id = s.item_id LEFT JOIN categories c ON c.item_category_id = i.item_category_id GROUP BY ALL",
    "monthly_price_units": "SELECT * FROM priced WHERE month_id <= 60",
    "monthly_price_units_test": "SELECT * FROM priced WHERE month_id = 61",
    "pair_means": "SELECT shop_id, item_id, round(item_price_mean, 6) AS item_price_mean, item_cnt_month FROM pairs",
    "category_mean_of_means": "SELECT item_category_id, round(item_cat_price_mean, 6) AS item_cat_price_mean FROM cat_price",
    "price_context": 'SELECT "ID", shop_id, item_id, item_category_id, round(item_price_mean, 6) AS item_price_mean, round(item_cat_price_mean, 6) AS item_cat_price_mean FROM context',
    "price_fallback": 'SELECT "ID", round(CASE WHEN item_price_mean IS NULL THEN item_cat_price_mean ELSE item_price_mean END, 6) AS item_price FROM context',
    "price_item": "SELECT item_id, item_avg_item_price FROM price_item",
    "price_as_of": """
        SELECT k.month_id, k.item_id, CAST(sum(c.item_price) AS DOUBLE) / count(c.item_price) AS item_avg_item_price
        FROM price_month_item k JOIN cleaned c ON c.item_id = k.item_id AND c.month_id <= k.month_id
        GROUP BY k.month_id, k.item_id""",
    "revenue_as_of": """
        SELECT k.month_id, k.shop_id, CAST(sum(r.rev) AS DOUBLE) / count(*) AS shop_avg_revenue
        FROM revenue k JOIN revenue r ON r.shop_id = k.shop_id AND r.month_id <= k.month_id
        GROUP BY k.month_id, k.shop_id""",
    "price_month_item": "SELECT month_id, item_id, item_monthly_avg_item_price FROM price_month_item",
    "shop_revenue": "SELECT month_id, shop_id, CAST(rev AS DOUBLE) AS shop_monthly_revenue FROM revenue",
    "shop_avg_revenue": "SELECT shop_id, avg_rev AS shop_avg_revenue FROM avg_revenue",
    "price_delta_lags": "SELECT month_id, shop_id, item_id, d1 AS delta_price_lag_1, d2 AS delta_price_lag_2, d3 AS delta_price_lag_3 FROM deltas",
    "price_trend": f"SELECT month_id, shop_id, item_id, {walk_sql([1, 2, 3])} AS delta_price_lag FROM deltas",
    "price_trend_long": f"SELECT month_id, shop_id, item_id, {walk_sql([1, 2, 3, 4, 5, 6])} AS delta_price_lag FROM deltas6",
    "revenue_trend": "SELECT month_id, shop_id, item_id, coalesce("
    + months_back("(CAST(rev AS DOUBLE) - avg_rev) / avg_rev", 1)
    + ", 0) AS delta_revenue_lag_1 FROM panel LEFT JOIN revenue USING (month_id, shop_id) LEFT JOIN avg_revenue USING (shop_id)",
    "month_features": "SELECT month_id, count(*) AS n, month_id % 12 AS month, [31,28,31,30,31,30,31,31,30,31,30,31][month_id % 12 + 1] AS days FROM cleaned GROUP BY month_id",
    "first_month": "SELECT shop_id, item_id, pair_first_month, item_first_month FROM (SELECT shop_id, item_id, min(month_id) AS pair_first_month FROM monthly GROUP BY ALL) LEFT JOIN (SELECT item_id, min(month_id) AS item_first_month FROM panel GROUP BY ALL) USING (item_id)",
    "last_sale_shop_item": "SELECT p.month_id, p.shop_id, p.item_id, m.month_id AS last_sale_month FROM panel p ASOF LEFT JOIN monthly m ON p.shop_id = m.shop_id AND p.item_id = m.item_id AND p.month_id > m.month_id",
    "last_sale_item": "SELECT p.month_id, p.shop_id, p.item_id, m.month_id AS last_sale_month FROM panel p ASOF LEFT JOIN (SELECT DISTINCT month_id, item_id FROM monthly) m ON p.item_id = m.item_id AND p.month_id > m.month_id",
    "since_first": "SELECT month_id, shop_id, item_id, month_id - min(month_id) OVER (PARTITION BY shop_id, item_id) AS item_shop_first_sale, month_id - min(month_id) OVER (PARTITION BY item_id) AS item_first_sale FROM panel",
    "since_first_sale": "SELECT p.month_id, p.shop_id, p.item_id, CASE WHEN p.month_id > f THEN f ELSE -1 END AS first_sale_in_shop, CASE WHEN p.month_id > f THEN p.month_id - f ELSE -1 END AS months_since_first_sale_in_shop FROM panel p LEFT JOIN (SELECT shop_id, item_id, min(month_id) AS f FROM monthly GROUP BY ALL) m ON m.shop_id = p.shop_id AND m.item_id = p.item_id",
    "item_seniority": "SELECT month_id, shop_id, item_id, item_seniority FROM senior",
    "token_first": "SELECT 'shop' AS kind, CAST(shop_id AS BIGINT) AS id, split_part(shop_name, ' ', 1) AS word, nullif(regexp_extract(shop_name, '(\\S+)\\s', 1), '') AS first_run FROM shops UNION ALL SELECT 'item', item_id, split_part(item_name, ' ', 1), nullif(regexp_extract(item_name, '(\\S+)\\s', 1), '') FROM items",
    "token_second": "SELECT shop_id, split_part(shop_name, ' ', 2) AS word FROM shops",
    "subtype_split": f"SELECT name, n, {_SUB} AS subtype FROM (SELECT o_orderpriority AS name, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT item_category_name, count(*) FROM categories GROUP BY ALL)",
    "greedy_prefix": "SELECT item_category_id, item_category_name, left(item_category_name, strpos(item_category_name, ' -') - 1) AS prefix FROM categories",
    "multi_match": f"SELECT item_id, CASE WHEN c = '' THEN 'None' ELSE c END AS console FROM (SELECT item_id, {_CONSOLE} AS c FROM items)",
    "contains_flag": "SELECT item_id, CASE WHEN item_name LIKE '%[%' THEN 1 ELSE 0 END AS flag FROM items",
    "bracket_parts": "SELECT item_id, name2, name3 FROM item_cut",
    "normalise_name": f"SELECT doc_id, trim(regexp_replace(split_part(split_part(lower(text), '[', 1), '(', 1), '{NOT_NAME}', ' ', 'g')) AS name FROM documents",
    "unify_tokens": "SELECT item_id, type FROM item_typed",
    "value_counts": "SELECT name2, count(*) AS n, CASE WHEN count(*) > 4 THEN 1 ELSE 0 END AS frequent FROM item_parts GROUP BY name2",
    "label_encode": "SELECT item_id, item_name, dense_rank() OVER (ORDER BY item_name) - 1 AS code FROM items",
    "factorise": "SELECT item_id, item_name, dense_rank() OVER (ORDER BY f) - 1 AS code FROM (SELECT item_id, item_name, min(item_id) OVER (PARTITION BY item_name) AS f FROM items)",
    "dict_code": "SELECT item_category_id, grp AS \"group\", CASE grp WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'PROMO' THEN 3 WHEN 'SMALL' THEN 4 END AS code FROM group_words",
    "rare_bucket": "SELECT shop_id, kind FROM shop_kinds",
    "rare_bucket_cross": "SELECT item_id, item_category_id, name2, name3 FROM item_parts",
    "one_hot": "SELECT p_partkey, p_type, p_size, "
    + ", ".join(f"(p_type = '{t}')::INT AS \"p_type_{t}\"" for t in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"))
    + ", "
    + ", ".join(f"(p_size = {n})::INT AS p_size_{n}" for n in range(1, 51))
    + " FROM part",
    "min_max_scale": "SELECT month_id, item_category_id, shop_id, item_id, (item_price - lp) / (hp - lp) AS item_price, (item_cnt_month - lq) / (hq - lq) AS item_quantity FROM priced, (SELECT min(item_price) AS lp, max(item_price) AS hp, min(item_cnt_month) AS lq, max(item_cnt_month) AS hq FROM priced WHERE month_id < 70)",
    "standardise": "SELECT month_id, item_category_id, shop_id, item_id, round((item_price - mp) / sp, 6) AS item_price, round((item_cnt_month - mq) / sq, 6) AS item_quantity FROM priced, (SELECT avg(item_price) AS mp, stddev_pop(item_price) AS sp, avg(item_cnt_month) AS mq, stddev_pop(item_cnt_month) AS sq FROM priced WHERE month_id < 70)",
    "sorted_head": "SELECT month_id, shop_id, item_id, item_quantity FROM dense ORDER BY month_id, shop_id, item_id LIMIT 100",
    "top_k": "SELECT shop_id, item_id, units FROM (SELECT shop_id, item_id, sum(item_quantity) AS units FROM cleaned GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY shop_id ORDER BY units DESC, item_id) <= 5",
    "union_segments": "SELECT month_id, shop_id, item_id, item_quantity, item_seniority FROM senior WHERE item_seniority IN (0, 1, 2)",
    "number_rows": 'SELECT shop_id, item_id, row_number() OVER (ORDER BY shop_id, item_id) - 1 AS "ID" FROM test',
    "extremes": "SELECT min(date) AS first_date, (SELECT item_id FROM sales ORDER BY item_price DESC, item_id LIMIT 1) AS priciest_item, (SELECT max(item_category_id) + 1 FROM items) AS n_category_codes FROM sales",
    "describe": describe_sql("sales", ["item_price", "item_quantity"]),
    "null_profile": "SELECT c AS \"column\", rows, filled, rows - filled AS missing FROM (SELECT count(*) AS rows, count(month_id) AS f0, count(shop_id) AS f1, count(item_id) AS f2, count(item_quantity) AS f3, count(item_quantity_lag_1) AS f4, count(item_quantity_lag_2) AS f5, count(item_quantity_lag_3) AS f6 FROM lagged) CROSS JOIN LATERAL (VALUES ('month_id', f0), ('shop_id', f1), ('item_id', f2), ('item_quantity', f3), ('item_quantity_lag_1', f4), ('item_quantity_lag_2', f5), ('item_quantity_lag_3', f6)) v(c, filled)",
    "rmse_baseline": "SELECT avg(e * e) AS mse, sqrt(avg(e * e)) AS rmse FROM (SELECT item_quantity_lag_1 - item_quantity AS e FROM lagged)",
    "time_split": f"SELECT CASE WHEN month_id < {T - 1} THEN 'train' WHEN month_id = {T - 1} THEN 'validation' ELSE 'test' END AS split, count(*) AS n, sum(item_quantity) AS units FROM panel GROUP BY 1",
    "segment_split": f"SELECT v.split, k.seniority, count(s.item_id) AS n, CAST(sum(s.shop_id * s.item_id) AS BIGINT) AS key_sum FROM (VALUES ('validation', {T - 1}), ('test', {T})) v(split, m) CROSS JOIN (VALUES (0), (1), (2)) k(seniority) LEFT JOIN senior s ON s.month_id = v.m AND s.item_seniority = k.seniority GROUP BY ALL",
    "random_split": f"SELECT month_id, item_category_id, shop_id, item_id, CASE WHEN row_number() OVER (ORDER BY {_SCORE}, month_id, item_category_id, shop_id, item_id) <= floor(0.2 * (SELECT count(*) FROM priced WHERE month_id <= 60)) THEN 1 ELSE 0 END AS is_val FROM priced WHERE month_id <= 60",
    "gram_matrix": f"SELECT {_GRAM}, sum(y * y) AS yy, count(*) AS n FROM (SELECT CAST(month_id AS DOUBLE) AS a, CAST(item_category_id AS DOUBLE) AS b, CAST(shop_id AS DOUBLE) AS c, CAST(item_id AS DOUBLE) AS d, trunc(item_price) AS e, item_cnt_month AS y FROM priced WHERE month_id <= 60)",
    "ols_fit": solved_sql(0.0),
    "ridge_fit": solved_sql(5.0),
    "submission_join": 'SELECT "ID", y AS item_cnt_month FROM test LEFT JOIN recent12 USING (shop_id, item_id)',
    "ensemble_mean": 'SELECT "ID", (coalesce(a.y, 0) + coalesce(b.y, 0)) / 2 AS item_cnt_month FROM test LEFT JOIN recent12 a USING (shop_id, item_id) LEFT JOIN recent24 b USING (shop_id, item_id)',
    "compare_forecasts": describe_sql("both_forecasts", ["first", "second", "difference"]),
}
_EXTRA: dict[str, str] = {
    "split_rows": "SELECT *, row_number() OVER (ORDER BY "
    + f"{_SCORE}, month_id, item_category_id, shop_id, item_id) AS place, count(*) OVER () AS total FROM priced WHERE month_id <= 60",
    "trained_gram": f"SELECT {_GRAM} FROM (SELECT CAST(month_id AS DOUBLE) AS a, CAST(item_category_id AS DOUBLE) AS b, "
    "CAST(shop_id AS DOUBLE) AS c, CAST(item_id AS DOUBLE) AS d, trunc(item_price) AS e, item_cnt_month AS y "
    "FROM split_rows WHERE place > floor(0.2 * total))",
    "deltas": delta_rows([1, 2, 3]),
    "deltas6": delta_rows([1, 2, 3, 4, 5, 6]),
    "lagged": lag_sql("dense", [1, 2, 3]),
    "both_forecasts": "SELECT first, second, first - second AS difference FROM (SELECT coalesce(a.y, 0) AS first, coalesce(b.y, 0) AS second FROM test LEFT JOIN recent12 a USING (shop_id, item_id) LEFT JOIN recent24 b USING (shop_id, item_id))",
}

ORACLES: dict[str, str] = {name: with_ctes(body, _EXTRA) for name, body in _BODIES.items()}
for _name, _encoding in ENCODED.items():
    ORACLES[f"mean_encode_{_name}"] = mean_sql(_encoding.keys)
    ORACLES[f"lagged_mean_{_name}"] = lagged_mean_sql(_encoding.keys, _encoding.lags)
ORACLES["features_full"] = feature_digest_sql(b.LATE)
ORACLES["features_early_clip"] = feature_digest_sql(b.EARLY)
ORACLES["features_segmented"] = feature_digest_sql(b.SEGMENT)
ORACLES["features_long_lags"] = feature_digest_sql(b.LONG)

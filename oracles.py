"""SQL text for an independent engine, one statement per named query.

Each statement works another way than the Spark plan it checks (decimals, row
numbers, IN lists, textbook series), so that an agreement of both means something.
"""

from __future__ import annotations

import re


def rnd(x: str, digits: int = 2) -> str:
    scale = f"1{'0' * digits}"
    return f"(sign({x})*floor(abs({x})*{scale}.0+0.5)/{scale}.0)"


def text_hash(x: str) -> str:
    """The first 15 hex digits of the md5 of a text, as a number."""
    return f"cast('0x' || substr(md5({x}), 1, 15) AS bigint)"


CTES = {
    "src": f"""
SELECT cast(l_orderkey AS varchar) AS "InvoiceNo",
       cast(l_partkey AS varchar) AS "StockCode",
       p_name AS "Description",
       cast(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_quantity
                 ELSE l_quantity END AS bigint) AS "Quantity",
       strftime(o_orderdate, '%m/%d/%y %H:%M') AS "InvoiceDate",
       {rnd('(l_extendedprice/l_quantity/100.0)')} AS "UnitPrice",
       cast(o_custkey AS varchar) AS "CustomerID",
       n_name AS "Country"
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "daily": """
SELECT CustomerID AS customer_id,
       cast(strptime(substr(InvoiceDate, 1, 8), '%m/%d/%y') AS date) AS order_date,
       sum(cast(UnitPrice AS decimal(18,4)) * Quantity) AS raw_value,
       cast(sum(Quantity) AS bigint) AS order_qty_articles
FROM src WHERE CustomerID IS NOT NULL GROUP BY 1, 2""",
    "orders_": """
SELECT customer_id, order_date, round(raw_value, 2) AS order_value, order_qty_articles
FROM daily""",
    "latest": "SELECT customer_id, max(order_date) AS latest_order FROM daily GROUP BY ALL",
    "positive": """
SELECT customer_id, count(*) FILTER (raw_value > 0) AS cnt_positive_value
FROM daily WHERE order_date < DATE '2000-06-30' GROUP BY ALL""",
    "cleaned": """
FROM orders_
WHERE customer_id IN (SELECT customer_id FROM positive WHERE cnt_positive_value > 1)
  AND customer_id IN (SELECT customer_id FROM latest
                      WHERE latest_order >= DATE '2001-08-01' - INTERVAL 90 DAY)
  AND sign(order_value) * sign(order_qty_articles) = 1""",
    "ranked": """
SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date) AS nth,
       order_date <= DATE '2000-06-30' AS early
FROM cleaned""",
    "rfm": """
SELECT customer_id,
       sum(order_value) FILTER (early) :: DOUBLE AS monetary_dnn,
       coalesce(sum(order_value) FILTER (early AND nth > 1) :: DOUBLE
                / nullif(count(*) FILTER (early) - 1, 0), 0.0) AS monetary_btyd,
       (max(order_date) FILTER (early)) - (min(order_date) FILTER (early)) AS recency,
       DATE '2000-06-30' - (min(order_date) FILTER (early)) AS "T",
       count(*) FILTER (early) AS cnt_orders,
       sum(order_qty_articles) FILTER (early) :: DOUBLE / count(*) FILTER (early)
         AS avg_basket_size,
       sum(order_value) FILTER (early) :: DOUBLE / count(*) FILTER (early) AS avg_basket_value,
       count(*) FILTER (early AND order_value < 1) AS cnt_returns
FROM ranked GROUP BY ALL HAVING bool_or(early)""",
    "spent": """
SELECT customer_id, sum(order_value) :: DOUBLE AS target_monetary FROM cleaned GROUP BY ALL""",
    "feats": f"""
SELECT customer_id, monetary_dnn, monetary_btyd,
       cnt_orders AS frequency_dnn, cnt_orders - 1 AS frequency_btyd, recency, "T",
       {rnd('(recency/cnt_orders)')} AS time_between,
       {rnd('avg_basket_value')} AS avg_basket_value,
       {rnd('avg_basket_size')} AS avg_basket_size,
       cnt_returns,
       (cnt_returns > 0) :: INT AS has_returned,
       least(cnt_orders - 1, @freq) AS frequency_btyd_clipped,
       least({rnd('monetary_btyd')}, @money) AS monetary_btyd_clipped,
       least(target_monetary, @money) AS target_monetary_clipped,
       target_monetary
FROM rfm JOIN spent USING (customer_id)
WHERE monetary_dnn BETWEEN 0.01 AND 25000 AND monetary_btyd > 0""",
    "labelled": f"""
SELECT *, CASE bucket WHEN 85000 THEN 'none'
         ELSE list_extract(['train', 'eval', 'test'],
                           1 + (bucket > 70000)::INT + (bucket > 85000)::INT) END AS split
FROM (SELECT *, {text_hash('customer_id')} % 100000 AS bucket FROM feats)""",
    "days": """
SELECT date_diff('day', min(order_date), DATE '2000-06-30') AS feature_days,
       date_diff('day', DATE '2000-06-30', DATE '2001-08-01') AS target_days FROM cleaned""",
    "base": """
SELECT customer_id,
       avg_basket_value * (cnt_orders * (1 + target_days / feature_days)) AS predicted_monetary,
       target_monetary
FROM rfm JOIN spent USING (customer_id) CROSS JOIN days""",
    "lines": f"""
SELECT cast(to_json({{'customer_id': customer_id,
                     'predicted_monetary': {rnd('predicted_monetary')}}}) AS varchar) AS value
FROM base""",
    "moments": """
SELECT *, strptime("InvoiceDate", '%m/%d/%y %H:%M') AS moment FROM src""",
    "numbered": """
SELECT date_diff('day', cast((SELECT min(moment) FROM moments) AS date), cast(moment AS date))
         AS day_number, * EXCLUDE (moment)
FROM moments""",
    "money": """
SELECT customer_id, target_monetary AS monetary FROM spent""",
    "freq": """
SELECT customer_id, max(nth) - 1 AS num_transactions FROM ranked GROUP BY ALL""",
    "rec": """
SELECT customer_id, max(order_date) - min(order_date) AS recency FROM cleaned GROUP BY ALL""",
    "summary": """
SELECT customer_id, frequency_btyd AS frequency, recency, "T", monetary_btyd AS monetary_value
FROM feats""",
    "binned": """
SELECT customer_id, has_returned, frequency_dnn, recency,
       CASE WHEN recency < 250 THEN 0 WHEN recency < 500 THEN 1 WHEN recency < 1000 THEN 2
            WHEN recency < 1500 THEN 3 ELSE 4 END AS recency_bin
FROM feats""",
    "crosses": f"""
SELECT customer_id,
       CASE WHEN frequency_dnn >= 0 AND frequency_dnn < 12 THEN
         {text_hash("recency_bin || '_X_' || frequency_dnn || '_X_' || has_returned")} % 120
       END AS crossed
FROM binned""",
}

# Order in which the blocks build on one another.
ORDER = list(CTES)


def _needed(body: str) -> list[str]:
    """Blocks a statement reads, directly or through other blocks, in build order."""
    found: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"[a-z_]+", todo.pop()))
        for name in ORDER:
            if name in words and name not in found:
                found.add(name)
                todo.append(CTES[name])
    return [name for name in ORDER if name in found]


def statement(body: str, freq: str = "600", money: str = "100000.0") -> str:
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in _needed(body))
    text = f"WITH {head}\n{body}" if head else body
    return text.replace("@freq", freq).replace("@money", money)


FEATURE_COLUMNS = (
    'customer_id, monetary_dnn, monetary_btyd, frequency_dnn, frequency_btyd, recency, "T", '
    "time_between, avg_basket_value, avg_basket_size, cnt_returns, has_returned, "
    "frequency_btyd_clipped, monetary_btyd_clipped, target_monetary_clipped, target_monetary"
)
USED_COLUMNS = (
    "monetary_dnn", "frequency_dnn", "recency", "T", "time_between", "avg_basket_value",
    "avg_basket_size", "cnt_returns", "has_returned",
)
SCORING_COLUMNS = (
    'customer_id, monetary_dnn, frequency_dnn, recency, "T", time_between, avg_basket_value, '
    "avg_basket_size, cnt_returns, has_returned"
)


def profile(table: str, column: str, where: str = "true") -> str:
    x = f"cast({column} AS double)"
    q = {n: f"quantile_cont({x}, {f})" for n, f in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))}
    stats = {"mean": f"avg({x})", "std": f"stddev_samp({x})", "min": f"min({x})"}
    stats |= q | {"max": f"max({x})"}
    inner = ", ".join(f"{sql} AS v_{name}" for name, sql in stats.items())
    outer = ", ".join(f'{rnd(f"v_{name}", 6)} AS "{name}"' for name in stats)
    return (
        f'SELECT "count", {outer} FROM (SELECT count(*) AS "count", {inner} '
        f"FROM {table} WHERE {where})"
    )


# Repeat-purchase models at fixed parameters; x, tx, T, m per customer.
CUSTOMERS = 'SELECT customer_id, frequency AS x, recency AS tx, "T" AS tt_, monetary_value AS m FROM summary'
BG = {"r": 1.5, "al": 300.0, "a": 0.8, "b": 2.5}
PN = {"r": 1.5, "al": 300.0, "s": 0.6, "be": 400.0}
GG = {"p": 3.0, "q": 5.0, "v": 3000.0}


def fill(text: str, values: dict[str, float]) -> str:
    for name, value in values.items():
        text = text.replace(f"${name}$", str(value))
    return text


def hyp(a: str, b: str, c: str, z: str, terms: int = 300) -> str:
    """Power series of 2F1 by log-gammas; all parameters positive."""
    return f"""(SELECT sum(exp(lgamma(({a})+k)-lgamma({a})+lgamma(({b})+k)-lgamma({b})
      -lgamma(({c})+k)+lgamma({c})-lgamma(k+1)+k*ln({z}))) FROM (SELECT unnest(range({terms}))::DOUBLE AS k))"""


BG_LL = fill(
    """lgamma($r$+x)-lgamma($r$)+$r$*ln($al$)
  + lgamma($a$+$b$)+lgamma($b$+x)-lgamma($b$)-lgamma($a$+$b$+x)
  + ln(exp(-($r$+x)*ln($al$+tt_) + ($r$+x)*ln($al$+tx))
       + CASE WHEN x > 0 THEN $a$/($b$+x-1) ELSE 0 END) - ($r$+x)*ln($al$+tx)""",
    BG,
)
BG_ALIVE = fill(
    "(1/(1 + CASE WHEN x > 0 THEN $a$/($b$+x-1)*pow(($al$+tt_)/($al$+tx), $r$+x) ELSE 0 END))", BG
)


def bg_expected(days: str) -> str:
    series = hyp("$r$+x", "$b$+x", "$a$+$b$+x-1", f"({days})/($al$+tt_+({days}))")
    return fill(
        f"(($a$+$b$+x-1)/($a$-1)*(1-pow(($al$+tt_)/($al$+tt_+({days})), $r$+x)*{series})*{BG_ALIVE})",
        BG,
    )


def pn_g(u: str) -> str:
    """2F1 term for beta above alpha."""
    series = hyp("$r$+$s$+x", "$r$+x", "$r$+$s$+x+1", f"($be$-$al$)/($be$+{u})", 120)
    return fill(f"{series}*exp(($r$+x)*ln($al$+tt_)+$s$*ln($be$+tt_)-($r$+$s$+x)*ln($be$+{u}))", PN)


# Dropout odds: s/(r+s+x) (al+T)^(r+x) (be+T)^s A0.
PN_ODDS = fill(f"($s$/($r$+$s$+x)*({pn_g('tx')}-{pn_g('tt_')}))", PN)
PN_LL = fill(
    """lgamma($r$+x)-lgamma($r$)+$r$*ln($al$)+$s$*ln($be$)
  -($r$+x)*ln($al$+tt_)-$s$*ln($be$+tt_)+ln(1+odds)""",
    PN,
)
GG_LL = fill(
    """lgamma($p$*x+$q$)-lgamma($p$*x)-lgamma($q$)+$q$*ln($v$)+($p$*x-1)*ln(m)
  +$p$*x*ln(x)-($p$*x+$q$)*ln(x*m+$v$)""",
    GG,
)
GG_PROFIT = fill("($p$*($v$+x*m)/($p$*x+$q$-1))", GG)


def pn_expected(days: str) -> str:
    return fill(
        f"""(($r$+x)*($be$+tt_)/(($al$+tt_)*($s$-1))
        *(1-pow(($be$+tt_)/($be$+tt_+({days})), $s$-1))/(1+odds))""",
        PN,
    )


def clv(expected_at: str, source: str, extra: str = "", months: int = 14) -> str:
    """Sum over the months of discounted expected profit; ``e`` is expected purchases by month."""
    return f"""
SELECT customer_id, {extra} sum(profit*(e-e0)/pow(1.01, month)) AS clv FROM (
  SELECT *, coalesce(lag(e) OVER (PARTITION BY customer_id ORDER BY month), 0) AS e0 FROM (
    SELECT c.*, month, {GG_PROFIT} AS profit, {expected_at} AS e
    FROM ({source}) c, (SELECT unnest(range(1, {months + 1})) AS month)))
GROUP BY ALL"""


PN_CUSTOMERS = f"SELECT *, {PN_ODDS} AS odds FROM ({CUSTOMERS})"

DENSITY = f"""
WITH_BINS AS (SELECT -1000.0 + floor((monetary+1000.0)/50)*50.0 + 25 AS x, count(*) AS n
  FROM money WHERE monetary BETWEEN -1000 AND 15000 GROUP BY 1),
rule AS (SELECT sum(n) AS total, sqrt((sum(x*x*n)/sum(n) - pow(sum(x*n)/sum(n), 2))
    * sum(n)/(sum(n)-1)) * pow(sum(n), -0.2) AS h FROM with_bins)
SELECT point, {rnd('(d*1000000.0)', 6)} AS density FROM (
  SELECT -1000.0::DOUBLE + i*500.0 AS point,
         sum(n*exp(-0.5*pow((-1000.0 + i*500.0 - x)/h, 2))/sqrt(2*pi())/(total*h)) AS d
  FROM with_bins, rule, (SELECT unnest(range(33)) AS i) GROUP BY 1)"""


def density() -> str:
    """The density needs two blocks of its own after the shared ones."""
    shared = statement("SELECT * FROM money")
    head = shared[: shared.rindex("SELECT * FROM money")].rstrip()
    return f"{head},{DENSITY.replace('WITH_BINS', 'with_bins')}"


def score_equations(names: dict[str, str], where: str = "true") -> str:
    """Means that the score equations of a fit equate with the model's own."""
    return " UNION ALL ".join(
        f"""SELECT count(*) AS customers, '{name}' AS parameter, {rnd(f'avg({mean})', 3)} AS by_data,
        {rnd(f'avg({mean})', 3)} AS by_fit FROM ({CUSTOMERS}) WHERE {where}"""
        for name, mean in names.items()
    )


def ridge(settings: str, result: str) -> str:
    """Linear models by elimination on the correlations; ``settings`` has trial and l2."""
    shared = statement("SELECT * FROM labelled")
    head = shared[: shared.rindex("SELECT * FROM labelled")].rstrip()
    inputs = ", ".join(f'"{name}"::DOUBLE' for name in (*USED_COLUMNS, "target_monetary"))
    k = len(USED_COLUMNS)
    return f"""{head.replace("WITH", "WITH RECURSIVE", 1)},
cells AS (SELECT customer_id, split, unnest(range(1, {k + 2})) AS k, unnest([{inputs}]) AS x FROM labelled),
spread AS (SELECT k, avg(x) AS m, stddev_pop(x) AS s FROM cells WHERE split = 'train' GROUP BY k),
z AS (SELECT c.*, m, s, CASE WHEN s > 1e-12 * greatest(1, abs(m)) THEN (x - m) / s ELSE 0 END AS z
  FROM cells c JOIN spread USING (k)),
alike AS (SELECT a.k AS i, b.k AS j, avg(a.z * b.z) AS r FROM z a JOIN z b USING (customer_id)
  WHERE a.split = 'train' GROUP BY ALL),
matrix AS (SELECT list(line ORDER BY i) AS r FROM (
  SELECT i, list(r ORDER BY j) AS line FROM alike WHERE i <= {k} GROUP BY i)),
settings AS ({settings}),
steps AS (
  SELECT trial, l2, 1 AS step,
    [[CASE WHEN i = j THEN r[i][j] + l2 + (r[i][i] = 0)::INT ELSE r[i][j] END FOR j IN range(1, {k + 2})]
      FOR i IN range(1, {k + 1})] AS a FROM settings, matrix
  UNION ALL
  SELECT trial, l2, step + 1,
    [CASE WHEN i = step THEN [v / a[step][step] FOR v IN a[i]]
      ELSE [a[i][j] - a[i][step] * a[step][j] / a[step][step] FOR j IN range(1, {k + 2})] END
      FOR i IN range(1, {k + 1})] FROM steps WHERE step <= {k}),
solved AS (SELECT trial, l2, unnest(range(1, {k + 1})) AS k, unnest([line[{k + 1}] FOR line IN a]) AS b
  FROM steps WHERE step = {k + 1}),
label AS (SELECT m AS label_mean, s AS label_spread FROM spread WHERE k = {k + 1}),
errors AS (
  SELECT trial, l2, split, sqrt(avg(pow(y - fitted, 2))) * any_value(label_spread) AS rmse FROM (
    SELECT trial, l2, split, customer_id, sum(b * z) AS fitted FROM solved JOIN z USING (k) GROUP BY ALL)
  JOIN (SELECT customer_id, z AS y FROM z WHERE k = {k + 1}) USING (customer_id), label GROUP BY trial, l2, split)
{result}"""


TRIALS = "SELECT t AS trial, 1e-4 * pow(1e6, ((t + 1) * 0.6180339887498949) % 1.0) AS l2 FROM range({n}) AS r(t)"
TERMS = ", ".join(f"'{name}'" for name in USED_COLUMNS)


def shared_head(table: str) -> str:
    """The shared blocks up to a table, for statements with blocks of their own."""
    shared = statement(f"SELECT * FROM {table}")
    return shared[: shared.rindex(f"SELECT * FROM {table}")].rstrip()


def stump(result: str) -> str:
    """Best first split of the label by the bins of an input; of equal ones the first."""
    inputs = ", ".join(f'"{name}"::DOUBLE' for name in USED_COLUMNS)
    k = len(USED_COLUMNS)
    return f"""{shared_head("labelled")},
cells AS (SELECT customer_id, split, target_monetary::DOUBLE AS y, unnest(range({k})) AS f,
  unnest([sign(x) * ln(1 + abs(x)) FOR x IN [{inputs}]]) AS x FROM labelled),
bounds AS (SELECT f, min(x) AS low, max(x) AS high FROM cells WHERE split = 'train' GROUP BY f),
binned AS (SELECT c.*, CASE WHEN high > low
    THEN greatest(0, least(31, floor((x - low) / (high - low) * 32)))::BIGINT ELSE 0 END AS bin
  FROM cells c JOIN bounds USING (f)),
base AS (SELECT avg(y) AS base, var_pop(y) * count(*) AS spread FROM binned WHERE split = 'train' AND f = 0),
hist AS (SELECT f, bin, count(*) AS n, sum(y - base) AS total FROM binned, base WHERE split = 'train' GROUP BY f, bin),
sums AS (SELECT f, bin, sum(n) OVER upto AS left_n, sum(total) OVER upto AS left_total,
    sum(n) OVER whole AS n, sum(total) OVER whole AS total
  FROM hist WINDOW whole AS (PARTITION BY f), upto AS (PARTITION BY f ORDER BY bin)),
gains AS (SELECT *, n - left_n AS right_n, total - left_total AS right_total,
    round((left_total * left_total / (left_n + 1.0::DOUBLE) + pow(total - left_total, 2) / (n - left_n + 1.0::DOUBLE)
      - total * total / (n + 1.0::DOUBLE)) / spread, 9) AS gain FROM sums, base),
best AS (SELECT * FROM gains WHERE left_n >= 5 AND right_n >= 5 AND gain > 0 ORDER BY gain DESC, f, bin LIMIT 1)
{result}"""


def information(result: str) -> str:
    """Mutual information of the bins of every pair of columns of the training rows."""
    names = (*USED_COLUMNS, "target_monetary")
    columns = ", ".join(f'"{name}"::DOUBLE' for name in names)
    listed = ", ".join(f"'{name}'" for name in names)
    return f"""{shared_head("labelled").replace("WITH", "WITH RECURSIVE", 1)},
cells AS (SELECT customer_id, unnest(range({len(names)})) AS k, unnest([{listed}]) AS name,
  unnest([sign(x) * ln(1 + abs(x)) FOR x IN [{columns}]]) AS x FROM labelled WHERE split = 'train'),
bounds AS (SELECT k, min(x) AS low, max(x) AS high FROM cells GROUP BY k),
binned AS (SELECT customer_id, k, name, CASE WHEN high > low
    THEN least(11, floor((x - low) / (high - low) * 12))::INT ELSE 0 END AS bin FROM cells JOIN bounds USING (k)),
joint AS (SELECT a.name AS "left", b.name AS "right", a.bin AS i, b.bin AS j, count(*)::DOUBLE AS n
  FROM binned a JOIN binned b ON a.customer_id = b.customer_id AND a.k <= b.k GROUP BY ALL),
parts AS (SELECT *, sum(n) OVER (PARTITION BY "left", "right") AS whole,
    sum(n) OVER (PARTITION BY "left", "right", i) AS ni, sum(n) OVER (PARTITION BY "left", "right", j) AS nj FROM joint),
told AS (SELECT "left", "right", sum(n / whole * ln(n / whole / (ni / whole * (nj / whole)))) AS information
  FROM parts GROUP BY "left", "right")
{result}"""


RANKING = f"""
, pairs AS (SELECT "left" AS a, "right" AS b, information AS h FROM told
  UNION SELECT "right", "left", information FROM told),
chosen AS (
  SELECT 0 AS place, []::VARCHAR[] AS names, NULL::VARCHAR AS input, 0.0::DOUBLE AS relevance, 0.0::DOUBLE AS redundancy
  UNION ALL
  SELECT place + 1, list_append(names, best.a), best.a, best.relevance, best.redundancy FROM (
    SELECT c.place, c.names, arg_max({{'a': r.a, 'relevance': r.h, 'redundancy': coalesce(o.h, 0.0)}},
      {{'gain': round(r.h - coalesce(o.h, 0.0), 9), 'first': -list_position(list_sort([{TERMS}]), r.a)}}) AS best
    FROM chosen c JOIN pairs r ON r.b = 'target_monetary' AND r.a <> r.b AND NOT list_contains(c.names, r.a)
    LEFT JOIN (SELECT c2.place, p.a, avg(p.h) AS h FROM chosen c2 JOIN pairs p ON list_contains(c2.names, p.b)
      GROUP BY c2.place, p.a) o ON o.place = c.place AND o.a = r.a
    WHERE c.place < {len(USED_COLUMNS)} GROUP BY c.place, c.names))
SELECT place, input, {rnd('relevance', 6)} AS relevance, {rnd('redundancy', 6)} AS redundancy,
  {rnd('(relevance - redundancy)', 6)} AS gain FROM chosen WHERE place > 0"""


def tree_sql() -> dict[str, str]:
    return {
        "boost_root": stump(
            f"""SELECT [{TERMS}][f + 1] AS input, bin, left_n::BIGINT AS left_n, right_n::BIGINT AS right_n,
            {rnd('left_total / left_n')} AS left_mean, {rnd('right_total / right_n')} AS right_mean FROM best"""
        ),
        "boost_curve": stump(
            f""", fitted AS (
              SELECT split, y, base.base, coalesce(0.5 * CASE WHEN b.bin > best.bin
                THEN right_total / (right_n + 1.0::DOUBLE) ELSE left_total / (left_n + 1.0::DOUBLE) END, 0) AS step
              FROM binned b CROSS JOIN base LEFT JOIN best ON true WHERE b.f = coalesce(best.f, 0)),
            rounds AS (SELECT split, unnest([0, 1])::BIGINT AS round, unnest([y - base, y - base - step]) AS rest FROM fitted)
            SELECT split, round, count(*) AS n, {rnd('sqrt(avg(rest * rest))')} AS rmse, {rnd('avg(abs(rest))')} AS mae
            FROM rounds GROUP BY split, round"""
        ),
        "boost_rungs": f"""{shared_head("labelled")},
            mean AS (SELECT avg(target_monetary) AS base FROM labelled WHERE split = 'train'),
            error AS (SELECT sqrt(avg(pow(target_monetary - base, 2))) AS e FROM labelled, mean WHERE split = 'eval')
            SELECT rung, rounds, trials, stay, trials AS different, true AS better, {rnd('e')} AS rmse_of_mean
            FROM (VALUES (0, 1, 100::BIGINT, 33::BIGINT), (1, 2, 33, 11), (2, 4, 11, 3), (3, 8, 3, 1))
              AS rungs(rung, rounds, trials, stay), error""",
        "feature_information": information(
            f"""SELECT "left", "right", {rnd('information', 6)} AS information FROM told"""
        ),
        "feature_ranking": information(RANKING),
    }


def linear_sql() -> dict[str, str]:
    # Equal columns share their effect, as in the limit of a penalty that goes to zero.
    one = "SELECT 0 AS trial, 1e-10::DOUBLE AS l2"
    return {
        "fit_linear": ridge(
            one,
            f"""SELECT term, {rnd('c', 2)} AS coefficient, {rnd('e', 1)} AS effect FROM (
            SELECT [{TERMS}][k] AS term, b * label_spread / if(s > 1e-12 * greatest(1, abs(m)), s, 1.0) AS c,
              b * label_spread AS e FROM solved JOIN spread USING (k), label
            UNION ALL SELECT 'intercept', any_value(label_mean)
              - sum(b * label_spread / if(s > 1e-12 * greatest(1, abs(m)), s, 1.0) * m), 0.0
              FROM solved JOIN spread USING (k), label HAVING count(*) > 0)""",
        ),
        "tune_linear": ridge(
            TRIALS.format(n=1000),
            f"""SELECT trial::INT AS trial, {rnd('log10(l2)', 6)} AS log_l2, {rnd('t.rmse')} AS train_rmse,
            {rnd('e.rmse')} AS rmse FROM errors t JOIN errors e USING (trial, l2)
            WHERE t.split = 'train' AND e.split = 'eval'""",
        ),
        "trials_table": ridge(
            TRIALS.format(n=20),
            f"""SELECT trial::INT AS trial, {rnd('log10(l2)', 6)} AS log_l2, {rnd('rmse')} AS rmse,
            row_number() OVER (ORDER BY {rnd('rmse', 6)}, trial)::INT AS place,
            (SELECT least(2, count(*)) FROM labelled WHERE split = 'train')::INT AS last_model
            FROM errors WHERE split = 'eval'""",
        ),
    }


SAMPLE_TEXT = (
    '"InvoiceNo" || "Quantity" || "InvoiceDate" || ("UnitPrice"::DECIMAL(18,4)) || "CustomerID"'
)

BODIES = {
    "src_transactions": "SELECT * FROM src",
    "line_value": """SELECT "InvoiceNo" AS invoice_no, "StockCode" AS stock_code,
       "CustomerID" AS customer_id, "Quantity" AS quantity,
       cast(cast("UnitPrice" AS decimal(18,4))*"Quantity" AS double) AS line_value FROM src""",
    "daily_orders": """SELECT customer_id, order_date, cast(order_value AS double) AS order_value,
       order_qty_articles FROM orders_""",
    "latest_order": "SELECT * FROM latest",
    "recently_active": """SELECT * FROM latest
       WHERE date_diff('day', latest_order, DATE '2001-08-01') <= 90""",
    "positive_days": "SELECT * FROM positive",
    "repeat_customers": "SELECT * FROM positive WHERE cnt_positive_value > 1",
    "sign_consistent": """SELECT customer_id, order_date, cast(order_value AS double) AS order_value,
       order_qty_articles FROM orders_ WHERE sign(order_value) * sign(order_qty_articles) = 1""",
    "clean_orders": """SELECT customer_id, order_date, cast(order_value AS double) AS order_value,
       order_qty_articles FROM cleaned""",
    "first_order": "SELECT customer_id, order_date AS order_date_min FROM ranked WHERE nth = 1",
    "first_order_zeroed": """SELECT customer_id, order_date,
       cast(order_value AS double) AS order_value, order_qty_articles,
       if(nth = 1, 0.0, cast(order_value AS double)) AS order_value_btyd FROM ranked""",
    "target": "SELECT * FROM spent",
    "target_after": """SELECT customer_id, cast(sum(order_value) AS double) AS target_monetary
       FROM cleaned WHERE order_date > DATE '2000-06-30' GROUP BY 1""",
    "features_rfm": "SELECT * FROM rfm",
    "features_n_target": "SELECT * FROM feats",
    "features_after": """SELECT feats.* EXCLUDE (target_monetary, target_monetary_clipped),
       least(t.later, @money) AS target_monetary_clipped, t.later AS target_monetary
       FROM feats JOIN (SELECT customer_id, sum(order_value) :: DOUBLE AS later FROM cleaned
         WHERE order_date > DATE '2000-06-30' GROUP BY 1) t USING (customer_id)""",
    "export_roundtrip": "SELECT * FROM feats",
    "hash_bucket": "SELECT customer_id, bucket FROM labelled",
    "split_train": f"SELECT {FEATURE_COLUMNS} FROM labelled WHERE split = 'train'",
    "split_eval": f"SELECT {FEATURE_COLUMNS} FROM labelled WHERE split = 'eval'",
    "split_test": f"SELECT {FEATURE_COLUMNS} FROM labelled WHERE split = 'test'",
    "shuffled_train": f"SELECT {FEATURE_COLUMNS} FROM labelled WHERE split = 'train'",
    "read_split_files": f"SELECT {FEATURE_COLUMNS}, split FROM labelled WHERE split <> 'none'",
    "csv_with_defaults": """SELECT * REPLACE (
       CASE WHEN has_returned = 1 THEN 1 ELSE -1 END AS has_returned,
       CASE WHEN frequency_btyd > 4 THEN monetary_btyd ELSE 0.0 END AS monetary_btyd) FROM feats""",
    "scoring_input": f"SELECT {SCORING_COLUMNS} FROM feats",
    "scoring_header": f"SELECT {SCORING_COLUMNS} FROM feats",
    "scoring_ndjson": f"SELECT {SCORING_COLUMNS} FROM feats",
    "table_roundtrip": "SELECT * FROM feats",
    "predictions_table": f"""SELECT customer_id, {rnd('predicted_monetary')} AS predicted_monetary,
       cast(NULL AS double) AS predictions FROM base""",
    "entity_store": f"""SELECT customer_id, {rnd(f"({rnd('predicted_monetary')} + if({text_hash('customer_id')} % 100000 < 50000, 1000.0::DOUBLE, 0.0))")}
       AS predicted_monetary FROM base""",
    "shard_names": """SELECT least(3, count(*)) AS shards, least(3, count(*)) AS names FROM base""",
    "score_serve": f"""SELECT '{{"key":{{"path":[{{"kind":"clv","name":' || to_json(customer_id)
       || '}}]}},"properties":{{"predicted_monetary":{{"doubleValue":' || to_json({rnd('g')})
       || '}}}}}}' AS entity
       FROM labelled l JOIN (SELECT has_returned, avg(target_monetary) AS g FROM labelled
         WHERE split = 'train' GROUP BY 1) m ON l.has_returned = m.has_returned""",
    "predictions_json": "SELECT value FROM lines",
    "predictions_load": f"""SELECT customer_id, {rnd('predicted_monetary')} AS predicted_monetary,
       cast(NULL AS double) AS predictions FROM base""",
    "latest_version": """SELECT max(year(order_date)) AS version,
       count(*) FILTER (WHERE year(order_date) = (SELECT max(year(order_date)) FROM cleaned))
       AS n_rows FROM cleaned""",
    "entity_json": f"""SELECT '{{"key":{{"path":[{{"kind":"clv","name":' || to_json(customer_id)
       || '}}]}},"properties":{{"predicted_monetary":{{"doubleValue":'
       || to_json({rnd('predicted_monetary')}) || '}}}}}}' AS entity FROM base""",
    "entity_errors": """SELECT text AS line FROM documents
       WHERE NOT coalesce(json_valid(text) AND substr(ltrim(text), 1, 1) = '{', false)""",
    "baseline_days": "SELECT * FROM days",
    "baseline_predictions": "SELECT * FROM base",
    "baseline_rmse": f"""SELECT {rnd('e')} AS rmse FROM (SELECT
       sqrt(sum(pow(predicted_monetary-target_monetary, 2))/count(1)) AS e FROM base)""",
    "baseline_mse": f"""SELECT {rnd('e')} AS mse FROM (SELECT
       sum(pow(predicted_monetary-target_monetary, 2))/count(1) AS e FROM base)""",
    "baseline_mae": f"""SELECT {rnd('e')} AS mae FROM (SELECT
       avg(abs(predicted_monetary-target_monetary)) AS e FROM base)""",
    "baseline_rmse_by_split": f"""SELECT split, n, {rnd('e')} AS rmse FROM (
       SELECT CASE WHEN b <= 70000 THEN 'train' WHEN b < 85000 THEN 'eval'
                   WHEN b > 85000 THEN 'test' ELSE 'none' END AS split, count(*) AS n,
              sqrt(avg(pow(predicted_monetary-target_monetary, 2))) AS e
       FROM (SELECT *, {text_hash('customer_id')} % 100000 AS b FROM base) GROUP BY 1)""",
    "evaluation_report": f"""SELECT n, {rnd('rm')} AS rmse, {rnd('ms')} AS mse, {rnd('ma')} AS mae,
       {rnd('rr', 6)} AS r2 FROM (SELECT count(*) AS n,
         sqrt(avg(pow(predicted_monetary-target_monetary, 2))) AS rm,
         avg(pow(predicted_monetary-target_monetary, 2)) AS ms,
         avg(abs(predicted_monetary-target_monetary)) AS ma,
         1 - sum(pow(predicted_monetary-target_monetary, 2))
             / (count(*)*var_pop(target_monetary)) AS rr FROM base)""",
    "explore_day_number": "SELECT * FROM numbered",
    "explore_sample": f"SELECT * FROM numbered WHERE {text_hash(SAMPLE_TEXT)} % 50 = 1",
    "explore_threshold_date": "SELECT min(moment) + INTERVAL 250 DAY AS threshold_moment FROM moments",
    "explore_threshold_share": f"""SELECT {rnd('s', 6)} AS share_before FROM (
       SELECT avg(CASE WHEN day_number < 250 THEN 1.0 ELSE 0.0 END) AS s FROM numbered)""",
    "explore_frequency": "SELECT * FROM freq",
    "explore_recency": "SELECT * FROM rec",
    "explore_monetary": "SELECT * FROM money",
    "explore_head": "SELECT * FROM money ORDER BY customer_id LIMIT 2",
    "profile_monetary": profile("money", "monetary"),
    "profile_frequency": profile("freq", "num_transactions"),
    "profile_recency": profile("rec", "recency"),
    "profile_sample": " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", * FROM ({profile('numbered', f'"{name}"', f"{text_hash(SAMPLE_TEXT)} % 50 = 1")})"""
        for name in ("day_number", "Quantity", "UnitPrice")
    ),
    "profile_unit_price": profile("src", '"UnitPrice"'),
    "profile_continuous": profile(
        "orders_", "(order_value::DOUBLE / order_qty_articles)", "order_qty_articles <> 0"
    ),
    "profile_quantity": profile("src", '"Quantity"'),
    "monetary_histogram": """SELECT cast(floor((monetary+1000)/500) AS bigint) AS bin,
       -1000.0::DOUBLE + floor((monetary+1000)/500)*500 AS bin_start, count(*) AS n
       FROM money WHERE monetary BETWEEN -1000 AND 15000 GROUP BY 1, 2""",
    "training_matrix": """SELECT customer_id,
       CASE WHEN has_returned = 0 THEN 1 ELSE 0 END AS has_returned_0,
       CASE WHEN has_returned = 1 THEN 1 ELSE 0 END AS has_returned_1,
       monetary_dnn, frequency_dnn, recency, "T", time_between, avg_basket_value,
       avg_basket_size, cnt_returns, target_monetary FROM feats""",
    "feat_vocab": """SELECT customer_id,
       CASE has_returned WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE -1 END AS returned_index,
       CASE cnt_returns WHEN 0 THEN 0 WHEN 2 THEN 1 ELSE -1 END AS returns_index FROM feats""",
    "feat_category": """SELECT customer_id, cnt_returns, place - 1 AS returns_category
       FROM feats JOIN (SELECT cnt_returns, row_number() OVER (
         ORDER BY count(*) DESC, cnt_returns::VARCHAR) AS place FROM feats GROUP BY 1)
       USING (cnt_returns)""",
    "feat_onehot": """SELECT customer_id, CASE WHEN cnt_returns = 0 THEN 1 ELSE 0 END AS cnt_returns_0,
       CASE WHEN cnt_returns = 1 THEN 1 ELSE 0 END AS cnt_returns_1 FROM feats""",
    "feat_bucketized": "SELECT customer_id, recency, recency_bin FROM binned",
    "feat_identity": """SELECT customer_id, CASE WHEN frequency_dnn BETWEEN 0 AND 9
       THEN frequency_dnn END AS frequency_index FROM feats""",
    "feat_crossed": "SELECT customer_id, crossed FROM crosses",
    "feat_cross_dim": f"""SELECT customer_id, {text_hash('crossed::VARCHAR')} % 3 AS slot,
       3::BIGINT AS width FROM crosses""",
    "regression_line": f"""SELECT {rnd('a', 6)} AS slope, {rnd('b', 6)} AS intercept FROM (
       SELECT regr_slope(target_monetary, monetary_dnn) AS a,
              regr_intercept(target_monetary, monetary_dnn) AS b
       FROM labelled WHERE split = 'train')""",
    "profile_sketched": " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count("{name}") AS count, {rnd(f'avg("{name}")', 4)} AS mean,
        {rnd(f'min("{name}")::DOUBLE', 4)} AS min, {rnd(f'max("{name}")::DOUBLE', 4)} AS max,
        if(count("{name}") > 0, true, NULL) AS quartiles_near FROM feats"""
        for name in (*USED_COLUMNS, "target_monetary")
    ),
    "fit_linear_normal": " UNION ALL ".join(
        f"""SELECT '{name}' AS input, {rnd('m', 0)} AS by_label, {rnd('m', 0)} AS by_fit FROM (
        SELECT avg("{name}" / 10.0::DOUBLE * target_monetary) AS m FROM labelled WHERE split = 'train')"""
        for name in USED_COLUMNS
    ),
    "fit_linear_wide": f"""SELECT l.customer_id, l.split, l.target_monetary,
       {rnd('g')} AS predicted_monetary
       FROM labelled l JOIN (SELECT has_returned, avg(target_monetary) AS g FROM labelled
         WHERE split = 'train' GROUP BY 1) m ON l.has_returned = m.has_returned""",
    "fit_proximal": f"""SELECT l.customer_id, {rnd('g', 1)} AS predicted_monetary
       FROM labelled l JOIN (SELECT has_returned, avg(target_monetary) AS g FROM labelled
         WHERE split = 'train' GROUP BY 1) m ON l.has_returned = m.has_returned""",
    "btyd_summary": "SELECT * FROM summary",
    "btyd_actuals": """SELECT customer_id, frequency_btyd AS train_frequency,
       monetary_dnn AS train_monetary, target_monetary AS act_target_monetary FROM feats""",
    "predict_horizon": """SELECT customer_id, frequency, recency, "T", target_days AS time_days,
       cast(ceil(target_days/30.0) AS bigint) AS time_months FROM summary, days""",
    "fit_bgnbd": score_equations({"r": "x", "alpha": "x", "a": "(x > 0)::INT", "b": "(x > 0)::INT"}),
    "fit_paretonbd": score_equations({"r": "x", "alpha": "x", "s": "(x > 0)::INT", "beta": "(x > 0)::INT"}),
    "fit_gamma_gamma": score_equations({"p": "x", "q": "ln(x * m)", "v": "x"}, "x > 0"),
    "bgnbd_nll": f"""SELECT customer_id, {rnd('ll', 6)} AS log_likelihood
       FROM (SELECT *, {BG_LL} AS ll FROM ({CUSTOMERS}))""",
    "paretonbd_nll": f"""SELECT customer_id, {rnd('ll', 6)} AS log_likelihood
       FROM (SELECT *, {PN_LL} AS ll FROM ({PN_CUSTOMERS}))""",
    "gamma_gamma_nll": f"""SELECT customer_id, {rnd('ll', 6)} AS log_likelihood
       FROM (SELECT *, {GG_LL} AS ll FROM ({CUSTOMERS}))""",
    "bgnbd_expected": f"""SELECT customer_id, {rnd('alive', 6)} AS p_alive,
       {rnd('e', 6)} AS expected_purchases
       FROM (SELECT *, {BG_ALIVE} AS alive, {bg_expected('397')} AS e FROM ({CUSTOMERS}))""",
    "paretonbd_expected": f"""SELECT customer_id, {rnd('(1/(1+odds))', 6)} AS p_alive,
       {rnd('e', 6)} AS expected_purchases
       FROM (SELECT *, {pn_expected('397')} AS e FROM ({PN_CUSTOMERS}))""",
    "gamma_gamma_expected": f"""SELECT customer_id, {GG_PROFIT} AS expected_profit
       FROM ({CUSTOMERS})""",
    "btyd_clv": f"""SELECT customer_id, {rnd('clv', 4)} AS clv
       FROM ({clv(bg_expected('30*month'), CUSTOMERS)})""",
    "btyd_clv_long": f"""SELECT customer_id, {rnd('clv', 2)} AS clv
       FROM ({clv(bg_expected('30*month'), CUSTOMERS, months=120)})""",
    "btyd_error": f"""SELECT customer_id, actual_total,
       {rnd('purchases', 4)} AS predicted_num_purchases, {rnd('clv', 4)} AS predicted_value,
       {rnd('(train_monetary+clv)', 4)} AS predicted_total,
       {rnd('(actual_total-(train_monetary+clv))', 4)} AS error
       FROM (SELECT v.customer_id, clv, purchases, monetary_dnn AS train_monetary,
                    target_monetary AS actual_total
             FROM ({clv(pn_expected('30*month'), PN_CUSTOMERS, pn_expected('397') + ' AS purchases,')}) v
             JOIN feats ON v.customer_id = feats.customer_id)""",
}


def all_statements() -> dict[str, str]:
    """Every statement by query name."""
    made = {name: statement(body) for name, body in BODIES.items()}
    made["features_clipped"] = statement(
        """SELECT customer_id, frequency_btyd_clipped, monetary_btyd_clipped,
       target_monetary_clipped FROM feats""",
        freq="10",
        money="2000.0",
    )
    made["monetary_density"] = density()
    return made | linear_sql() | tree_sql()

"""One query per class of SQL, all through ``run_sql``.

The text is standard SQL and serves as its own oracle on another engine.
Money is summed as a decimal, so that the order of rows cannot matter.
"""

from __future__ import annotations

from opsframe.plans.registry import query, table
from opsframe.sources import run_sql

JOIN_AGG = """
    SELECT n_name, count(*) AS lines,
           count(DISTINCT o_custkey) AS customers,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
             AS price
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name
"""

ROLLUP = """
    SELECT l_returnflag, l_linestatus, count(*) AS lines,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM lineitem
    GROUP BY ROLLUP (l_returnflag, l_linestatus)
"""

# The rank is bounded in the same query, so Spark cuts every group to its top
# rows before the shuffle and a customer with very many orders stays small.
WINDOW_RANK = """
    SELECT o_custkey, o_orderkey, o_totalprice, place
    FROM (SELECT o_custkey, o_orderkey, o_totalprice,
                 CAST(rank() OVER (PARTITION BY o_custkey
                                   ORDER BY o_totalprice DESC, o_orderkey)
                      AS BIGINT) AS place
          FROM orders) ranked
    WHERE place <= 3
"""

SET_OP = """
    SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal > 9000
    UNION
    SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000
    EXCEPT
    SELECT n_nationkey FROM nation WHERE n_regionkey = 0
"""

SEMI_ANTI = """
    SELECT c_custkey, c_name FROM customer
    WHERE EXISTS (SELECT 1 FROM orders
                  WHERE o_custkey = c_custkey AND o_orderstatus = 'O')
      AND NOT EXISTS (SELECT 1 FROM orders
                      WHERE o_custkey = c_custkey
                        AND o_orderpriority = '1-URGENT')
"""

TOPK = """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
"""


def _register(name: str, text: str, tables: list[str]) -> None:
    @query(name, text)
    def _plan(spark, sf_dir):
        views = {t: table(spark, sf_dir, t) for t in tables}
        return run_sql(spark, text, views=views)


_register(
    "sql_join_agg", JOIN_AGG, ["lineitem", "orders", "customer", "nation"]
)
_register("sql_rollup", ROLLUP, ["lineitem"])
_register("sql_window_rank", WINDOW_RANK, ["orders"])
_register("sql_set_op", SET_OP, ["customer", "supplier", "nation"])
_register("sql_semi_anti", SEMI_ANTI, ["customer", "orders"])
_register("sql_topk", TOPK, ["orders"])

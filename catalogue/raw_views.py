"""The six source tables, derived from the test tables with defects put in.

Whole tables are read; the CASE rules only decide which rows are made dirty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from stratamart.schemas import BRONZE_SCHEMAS


Read = Callable[[str], DataFrame]


def _padded(key: str, width: int) -> str:
    """Leading zeros up to the width, longer keys whole."""
    return f"lpad(string({key}), greatest({width}, length(string({key}))), '0')"


def _copies(name: str, twice: str) -> str:
    """0, and for some rows 0 and 1: one scan gives both copies."""
    return f"explode(CASE WHEN {twice} THEN array(0, 1) ELSE array(0) END) AS {name}"


def crm_cust_info(read: Read) -> DataFrame:
    df = read("customer").selectExpr("*", _copies("copy", "c_custkey % 50 = 3"))
    return df.selectExpr(
        "CASE WHEN c_custkey % 211 <> 7 THEN c_custkey END AS cst_id",
        f"'AW' || {_padded('c_custkey', 8)} AS cst_key",
        "CASE WHEN c_custkey % 97 <> 5 THEN '  ' || c_name || ' ' END AS cst_firstname",
        "c_mktsegment AS cst_lastname",
        "decode(c_custkey % 4, 0, 's', 1, 'M ', 2, ' ') AS cst_marital_status",
        "decode(c_custkey % 5, 0, 'M', 1, ' f', 2, '', 3, 'F') AS cst_gndr",
        "date_add(DATE '2020-01-01', int(c_custkey % 365)) AS cst_create_date",
    )


def crm_prd_info(read: Read) -> DataFrame:
    df = read("part").selectExpr("*", _copies("v", "p_partkey % 3 = 0"))
    return df.selectExpr(
        "p_partkey * 2 + v AS prd_id",
        "substring(p_type, 1, 2) || '-B' || string(p_size % 5) || '-P' || "
        f"{_padded('p_partkey', 6)} AS prd_key",
        "p_name || ' ' AS prd_nm",
        "CASE WHEN p_partkey % 40 <> 0 THEN int(floor(p_retailprice)) END AS prd_cost",
        "decode(p_partkey % 5, 0, 'R ', 1, 'm', 2, 'S', 3, 'T', '') AS prd_line",
        "date_add(DATE '2010-01-01', v * 365 + int(p_partkey % 100)) AS prd_start_dt",
        "CASE WHEN v = 0 AND p_partkey % 3 = 0 "
        "THEN date_add(DATE '2009-06-01', int(p_partkey % 100)) END AS prd_end_dt",
    )


def sales_lines(lineitem: DataFrame, orders: DataFrame, *extra: str) -> DataFrame:
    """Works on a stream of line items as well. ``extra`` are further columns."""
    ordered = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    df = lineitem.join(ordered, lineitem["l_orderkey"] == ordered["o_orderkey"])
    return df.selectExpr(
        "'SO' || string(l_orderkey) AS sls_ord_num",
        "CASE WHEN l_partkey % 500 = 1 THEN 'PX' ELSE 'P' END || "
        f"{_padded('l_partkey', 6)} AS sls_prd_key",
        "CASE WHEN o_custkey % 400 = 9 THEN -1 ELSE o_custkey END AS sls_cust_id",
        "CASE WHEN l_orderkey % 101 = 0 THEN 0 WHEN l_orderkey % 103 = 0 THEN 32154 "
        "WHEN l_orderkey % 307 = 0 THEN 20101332 ELSE "
        "year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) END "
        "AS sls_order_dt",
        "year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS sls_ship_dt",
        "year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 28 AS sls_due_dt",
        "CASE WHEN l_suppkey % 89 = 3 THEN NULL "
        "WHEN l_orderkey % 113 = 5 THEN -int(floor(l_extendedprice)) "
        "ELSE int(floor(l_extendedprice)) END AS sls_sales",
        "CASE WHEN l_orderkey % 97 = 4 THEN 0 ELSE int(l_quantity) END AS sls_quantity",
        "CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN -5 "
        "ELSE int(floor(l_extendedprice / l_quantity)) END AS sls_price",
        *extra,
    )


def crm_sales_details(read: Read) -> DataFrame:
    return sales_lines(read("lineitem"), read("orders"))


def erp_cust_az12(read: Read) -> DataFrame:
    return read("customer").selectExpr(
        f"CASE WHEN c_custkey % 2 = 0 THEN 'NAS' ELSE '' END || 'AW' || "
        f"{_padded('c_custkey', 8)} AS CID",
        "CASE WHEN c_custkey % 77 = 0 THEN DATE '2999-01-01' "
        "ELSE date_add(DATE '1950-01-01', int(c_custkey * 10 % 18000)) END AS BDATE",
        "decode(c_custkey % 6, 0, 'F', 1, 'Female', 2, ' M', 3, 'male ', 4, '') AS GEN",
    )


def erp_loc_a101(read: Read) -> DataFrame:
    customer, nation = read("customer"), read("nation")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).selectExpr(
        f"'AW-' || {_padded('c_custkey', 8)} AS CID",
        "CASE c_custkey % 7 WHEN 0 THEN 'DE' WHEN 1 THEN 'USA' WHEN 2 THEN 'US ' "
        "WHEN 3 THEN ' ' WHEN 4 THEN NULL ELSE n_name END AS CNTRY",
    )


def erp_px_cat_g1v2(read: Read) -> DataFrame:
    df = read("part").where(
        "NOT (substring(p_type, 1, 2) = 'EC' AND p_size % 5 = 4)"
    )
    return df.selectExpr(
        "substring(p_type, 1, 2) || '_B' || string(p_size % 5) AS ID",
        "' ' || p_type AS CAT",
        "'Class ' || string(p_size % 5) AS SUBCAT",
        "decode(p_size % 5, 0, 'Yes', 1, 'No ', 2, 'yes', 3, '', 'NO') AS MAINTENANCE",
    ).distinct()


RAW_VIEWS = {
    "crm_cust_info": crm_cust_info,
    "crm_prd_info": crm_prd_info,
    "crm_sales_details": crm_sales_details,
    "erp_cust_az12": erp_cust_az12,
    "erp_loc_a101": erp_loc_a101,
    "erp_px_cat_g1v2": erp_px_cat_g1v2,
}


def raw_table(read: Read, name: str) -> DataFrame:
    """A raw view in the column types of its bronze table."""
    return typed(RAW_VIEWS[name](read), name)


def typed(view: DataFrame, name: str, *extra: str) -> DataFrame:
    return view.selectExpr(*[
        f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in BRONZE_SCHEMAS[name].fields
    ], *extra)

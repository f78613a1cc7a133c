"""Catalogue-shaped views over the generated test tables.

The same SQL runs in Spark and in DuckDB, so both sides of a check see the same input.
"""

# view -> (the generated table it reads, its SQL)
VIEWS = {
    "v_ps": (
        "lineitem",
        """
SELECT concat('PL-', l_orderkey, ' ', l_linenumber, '.', l_partkey) AS pl_name,
       concat('HOST-', l_orderkey) AS hostname,
       CASE l_partkey % 10 WHEN 0 THEN 'Radial Velocity' WHEN 1 THEN 'Imaging' WHEN 2 THEN 'Microlensing'
            WHEN 3 THEN 'Eclipse Timing Variations' WHEN 4 THEN 'Orbital Brightness Modulation'
            WHEN 5 THEN 'Pulsar Timing' ELSE 'Transit' END AS discoverymethod,
       CAST(year(l_shipdate) + 22 AS INT) AS disc_year,
       CASE l_returnflag WHEN 'A' THEN 'Published Confirmed' WHEN 'R' THEN 'Published Candidate' END AS soltype,
       CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS default_flag,
       l_quantity * 7 AS pl_orbper,
       l_tax * 10 AS pl_orbsmax,
       CASE WHEN l_suppkey % 4 <> 0 THEN l_extendedprice / 100 END AS pl_masse,
       CASE WHEN l_suppkey % 5 <> 0 THEN l_quantity / 10 END AS pl_rade,
       CAST(100 + l_partkey % 500 AS INT) AS pl_eqt,
       CAST(3000 + l_orderkey % 4000 AS INT) AS st_teff,
       CAST(l_orderkey % 30 AS DOUBLE) / 10 AS st_rad,
       CAST(l_orderkey % 20 AS DOUBLE) / 10 AS st_mass,
       CAST(l_orderkey % 7 AS DOUBLE) / 10 AS st_met,
       CAST(l_orderkey % 1000 AS DOUBLE) / 10 AS sy_dist,
       CAST(1 + l_orderkey % 3 AS INT) AS sy_snum,
       CAST(1 + l_orderkey % 6 AS INT) AS sy_pnum,
       CAST(l_orderkey % 2 AS INT) AS sy_mnum,
       (l_orderkey * CAST(137.50776405 AS DOUBLE)) % CAST(360 AS DOUBLE) AS ra,
       ((l_orderkey * CAST(61.803398875 AS DOUBLE)) % CAST(180 AS DOUBLE)) - CAST(90 AS DOUBLE) AS dec
FROM lineitem
""",
    ),
    "v_toi": (
        "orders",
        """
SELECT concat(o_orderkey, '.01') AS toi, o_custkey AS tic_id, o_orderkey AS toipfx,
       concat('TOI-', o_orderkey) AS pl_name, concat('TIC-', o_custkey) AS hostname,
       CAST(1 + o_custkey % 90 AS DOUBLE) AS pl_orbper,
       o_totalprice / 10000 AS pl_rade,
       CAST(100 + o_orderkey % 900 AS INT) AS pl_eqt,
       CAST(o_orderkey % 160 AS DOUBLE) / 10 AS st_tmag,
       CASE o_orderstatus WHEN 'P' THEN 'PC' WHEN 'F' THEN 'FP' ELSE 'CP' END AS tfopwg_disp,
       (o_orderkey * CAST(137.50776405 AS DOUBLE)) % CAST(360 AS DOUBLE) AS ra,
       ((o_orderkey * CAST(61.803398875 AS DOUBLE)) % CAST(180 AS DOUBLE)) - CAST(90 AS DOUBLE) AS dec
FROM orders
""",
    ),
    "v_cumulative": (
        "part",
        """
SELECT p_partkey AS kepid, concat('K', p_partkey, '.01') AS kepoi_name,
       CASE p_size % 3 WHEN 0 THEN 'CONFIRMED' WHEN 1 THEN 'CANDIDATE' ELSE 'FALSE POSITIVE' END AS koi_disposition,
       CASE WHEN p_partkey % 8 <> 0 THEN CAST(p_partkey % 1000 AS DOUBLE) / 1000 END AS koi_score,
       CAST(p_size AS DOUBLE) * 3 AS koi_period,
       p_retailprice / 1000 AS koi_prad,
       CAST(200 + p_partkey % 1500 AS INT) AS koi_teq,
       CAST(p_size AS DOUBLE) / 10 AS koi_slogg,
       (p_partkey * CAST(137.50776405 AS DOUBLE)) % CAST(360 AS DOUBLE) AS ra,
       ((p_partkey * CAST(61.803398875 AS DOUBLE)) % CAST(180 AS DOUBLE)) - CAST(90 AS DOUBLE) AS dec
FROM part
""",
    ),
    "v_ml": (
        "customer",
        """
SELECT concat('ML-', c_custkey) AS pl_name, concat('MLHOST-', c_custkey) AS hostname,
       'Microlensing' AS discoverymethod,
       CAST(2000 + c_custkey % 25 AS INT) AS disc_year,
       CAST(c_custkey % 50 AS DOUBLE) / 10 AS pl_orbsmax,
       c_acctbal / 10 AS pl_masse,
       CAST(c_custkey % 20 AS DOUBLE) / 10 AS st_mass,
       CAST(1000 + c_custkey % 7000 AS DOUBLE) AS sy_dist,
       (c_custkey * CAST(137.50776405 AS DOUBLE)) % CAST(360 AS DOUBLE) AS ra,
       ((c_custkey * CAST(61.803398875 AS DOUBLE)) % CAST(180 AS DOUBLE)) - CAST(90 AS DOUBLE) AS dec
FROM customer
""",
    ),
    "v_targets": (
        "supplier",
        """
SELECT s_suppkey AS target_id,
       (s_suppkey * CAST(83.7 AS DOUBLE)) % CAST(360 AS DOUBLE) AS ra,
       ((s_suppkey * CAST(41.3 AS DOUBLE)) % CAST(180 AS DOUBLE)) - CAST(90 AS DOUBLE) AS dec
FROM supplier
""",
    ),
    "v_long": (
        "orders",
        """
SELECT o_orderkey,
       concat('12345678901', lpad(CAST(o_orderkey AS STRING), 9, '0')) AS source_id,
       concat('10000000', lpad(CAST(o_orderkey AS STRING), 10, '0')) AS short_id,
       CASE o_orderkey % 3 WHEN 0 THEN '9007199254740993' WHEN 1 THEN '1.5' ELSE concat('-', o_orderkey, '.250') END AS mixed,
       CASE o_orderkey % 2 WHEN 0 THEN concat(o_orderkey, '.125') ELSE '2.5e-3' END AS measure,
       concat('0.1', lpad(CAST(o_orderkey AS STRING), 19, '0'), '7') AS fine,
       concat('1', lpad(CAST(o_orderkey AS STRING), 40, '0')) AS endless
FROM orders
""",
    ),
    "v_raw": (
        "events",
        """
SELECT event_id,
       CASE event_id % 9 WHEN 0 THEN '' WHEN 1 THEN 'N/A' WHEN 2 THEN '--' WHEN 3 THEN 'NULL' WHEN 4 THEN 'n/a'
            WHEN 5 THEN concat(' ', event_id, ' ') WHEN 6 THEN concat('-', event_id, '.5') WHEN 7 THEN '1e3' ELSE 'NaN' END AS num_text,
       CASE event_id % 4 WHEN 0 THEN 'TRANSIT' WHEN 1 THEN 'Radial Velocity' WHEN 2 THEN 'imaging' ELSE 'Pulsar Timing' END AS method_text,
       CASE event_id % 4 WHEN 0 THEN '2015-03-01' WHEN 1 THEN '2015/03/02' WHEN 2 THEN '03/04/2015' ELSE 'spring 2015' END AS date_text,
       CASE event_id % 3 WHEN 0 THEN '217.42896' WHEN 1 THEN '-62.67947' ELSE '14h 29m 42.95s' END AS coord_text,
       concat('Kepler-', event_id, ' b') AS name_text
FROM events
""",
    ),
}

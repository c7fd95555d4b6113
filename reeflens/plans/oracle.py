"""Equivalent SQL (DuckDB dialect) for every registered query.

Used only to cross-check the Spark pipelines on the test tables.  The survey
view and its lookups are common table expressions; each query appends its
own.  Floating outputs are rounded to 6 decimals, as the Spark side does.
"""

from __future__ import annotations

VIEW = """
raw AS (
  SELECT
    year(o.o_orderdate) <= 1997 AS early,
    o.o_orderstatus AS label,
    CASE WHEN o.o_orderkey % 103 <> 9 THEN CAST(year(o.o_orderdate) AS INTEGER) END AS year,
    CASE WHEN o.o_custkey % 53 <> 11 THEN r.r_name END AS region,
    CASE WHEN o.o_custkey % 59 <> 13 THEN CAST(o.o_custkey AS VARCHAR) END AS reef,
    CASE WHEN o.o_orderkey % 61 <> 10 THEN l.l_linestatus END AS depth,
    CASE WHEN o.o_orderkey % 61 <> 12 THEN l.l_linenumber END AS transect,
    CASE WHEN o.o_orderkey % 83 <> 2 THEN l.l_returnflag END AS protection_level,
    CASE WHEN o.o_orderkey % 97 <> 3 THEN CAST(20.0 + CAST(c.c_nationkey AS DOUBLE) * 0.5 AS DOUBLE) END AS latitude,
    CASE WHEN o.o_orderkey % 89 <> 7 THEN split_part(p.p_name, ' ', 1) END AS family,
    CASE WHEN o.o_orderkey % 101 <> 5 THEN p.p_name END AS species,
    CASE WHEN o.o_orderkey % 79 <> 4 THEN p.p_type END AS taxa2,
    CASE WHEN o.o_orderkey % 73 <> 6 THEN p.p_brand END AS taxa3,
    CASE WHEN p.p_size > 45 THEN 'n/a' ELSE CAST(p.p_size AS VARCHAR) END AS trophic_level,
    CASE WHEN l.l_discount = 0 THEN NULL ELSE l.l_quantity * l.l_discount * 10 END AS size,
    CASE WHEN l.l_linenumber = 7 AND l.l_quantity > 40 THEN NULL
         ELSE l.l_quantity * CAST(p.p_size AS DOUBLE) END AS biomass,
    CASE WHEN o.o_orderkey % 67 = 1 THEN 0.0
         WHEN o.o_orderkey % 71 <> 8 THEN l.l_quantity END AS quantity
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
survey AS (
  SELECT * EXCLUDE (early), round_even(latitude, 0) AS degree
  FROM raw WHERE NOT early OR family <> 'cold'
),
comm_sp AS (
  SELECT p_name AS species,
         CASE WHEN min(p_retailprice) < 901.0 THEN 'yes'
              WHEN min(p_retailprice) >= 902.0 THEN 'no' END AS commercial
  FROM part GROUP BY p_name
),
group_traits AS (
  SELECT p_name AS species,
         TRY_CAST(CASE WHEN p_size > 45 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS DOUBLE)
           AS trophic_level,
         min(p_type) AS functional_name
  FROM part GROUP BY 1, 2
),
lats AS (
  SELECT r.r_name AS region, avg(CAST(20.0 + CAST(n.n_nationkey AS DOUBLE) * 0.5 AS DOUBLE)) AS lat
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name
)"""

# Q1: fish records, lookups, rules, outlier screen.
FISH = """
fish0 AS (
  SELECT s.label, s.year, s.region, s.reef, s.depth, s.transect, s.protection_level, s.latitude,
         s.family, s.species, s.taxa2, s.taxa3,
         CASE WHEN regexp_matches(s.trophic_level, '[dDfF]\\s*$') THEN NULL
              ELSE TRY_CAST(s.trophic_level AS DOUBLE) END AS trophic_level,
         s.size, s.biomass, s.quantity, s.degree,
         CASE WHEN c.commercial IS NULL THEN NULL
              WHEN c.commercial = 'yes' THEN 'Commercial' ELSE 'No commercial' END AS commercial
  FROM survey s LEFT JOIN comm_sp c ON s.species IS NOT DISTINCT FROM c.species
  WHERE s.label = 'F'
),
fish1 AS (
  SELECT f.*, g.functional_name
  FROM fish0 f LEFT JOIN group_traits g
    ON f.species IS NOT DISTINCT FROM g.species AND f.trophic_level IS NOT DISTINCT FROM g.trophic_level
  WHERE coalesce(f.region IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE'), false)
    AND NOT (coalesce(f.region IN ('AMERICA', 'EUROPE'), false)
             AND coalesce(f.family IN ('blue', 'red'), false) AND f.biomass > 1440.0)
    AND NOT (f.region = 'EUROPE' AND f.year = 1998 AND f.biomass > 1280.0)
),
quart AS (
  SELECT species, quantile_cont(size, 0.25) AS q1, quantile_cont(size, 0.75) AS q3
  FROM fish1 GROUP BY species
),
fish AS (
  SELECT f.*, q.q1, q.q3, q.q3 - q.q1 AS iqr,
         q.q1 - 1.5 * (q.q3 - q.q1) AS lower_bound, q.q3 + 1.5 * (q.q3 - q.q1) AS upper_bound,
         (f.size < q.q1 - 1.5 * (q.q3 - q.q1)) OR (f.size > q.q3 + 1.5 * (q.q3 - q.q1))
           AS size_flagged_outlier
  FROM fish1 f LEFT JOIN quart q ON f.species IS NOT DISTINCT FROM q.species
  WHERE NOT ((f.size < q.q1 - 1.5 * (q.q3 - q.q1)) OR (f.size > q.q3 + 1.5 * (q.q3 - q.q1)))
)"""


def sites_cte(src: str, name: str, threshold: str | None = None) -> str:
    """D2 over CTE ``src``: ``{name}_sites``, ``{name}_sel`` and ``{name}`` (kept rows)."""
    thr = threshold or (
        f"(SELECT CAST(ceil(min(mx) * (SELECT t FROM {name}_total) ) AS BIGINT) FROM "
        f"(SELECT region, max(coverage) AS mx FROM {name}_sites GROUP BY region))")
    return f"""
{name}_sy AS (SELECT DISTINCT region, reef, year FROM {src}),
{name}_total AS (SELECT count(*) AS t FROM (SELECT DISTINCT year FROM {name}_sy)),
{name}_sites AS (
  SELECT region, reef, count(*) AS years_monitored,
         CAST(count(*) AS DOUBLE) / CAST((SELECT t FROM {name}_total) AS DOUBLE) AS coverage
  FROM {name}_sy GROUP BY region, reef
),
{name}_kept AS (SELECT * FROM {name}_sites WHERE years_monitored >= {thr}),
{name} AS (
  SELECT * FROM {src} x WHERE EXISTS (
    SELECT 1 FROM {name}_kept k
    WHERE x.region IS NOT DISTINCT FROM k.region AND x.reef IS NOT DISTINCT FROM k.reef)
)"""


def reef_mean_cte(src: str, name: str, value: str, dims: tuple[str, ...] = (),
                  strict: bool = False, where: str = "TRUE") -> str:
    d = "".join(f", {c}" for c in dims)
    if strict:
        s = f"CASE WHEN count(*) = count({value}) THEN sum({value}) END"
        m = f"CASE WHEN count(*) = count({value}) THEN avg({value}) END"
    else:
        s = f"coalesce(sum({value}), 0)"
        m = f"avg({value})"
    return f"""
{name}_t AS (
  SELECT year, region, protection_level, reef, depth, transect{d}, {s} AS {value}
  FROM {src} WHERE {where}
  GROUP BY year, region, protection_level, reef, depth, transect{d}
),
{name} AS (
  SELECT year, region, protection_level, reef{d}, {m} AS {value}
  FROM {name}_t GROUP BY year, region, protection_level, reef{d}
)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)


def _round(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


FISH_COLS_DBL = ["latitude", "trophic_level", "size", "biomass", "quantity", "degree", "q1", "q3",
                 "iqr", "lower_bound", "upper_bound"]

SURVEY_DBL = ["latitude", "size", "biomass", "quantity", "degree"]
SURVEY_COLS = ["label", "year", "region", "reef", "depth", "transect", "protection_level",
               "latitude", "family", "species", "taxa2", "taxa3", "trophic_level", "size",
               "biomass", "quantity", "degree"]


def _sel(cols: list[str], dbl: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in dbl else c for c in cols)


def _case(col: str, mapping: list[tuple[str, object]]) -> str:
    parts = " ".join(
        f"WHEN {col} = '{k}' THEN " + (f"'{v}'" if isinstance(v, str) else str(v))
        for k, v in mapping)
    return f"CASE {parts} END"


PROT = [("A", "closed"), ("N", "mixed use"), ("R", "unprotected")]
FUNC = [("ECONOMY", "lone buyers"), ("LARGE", "bulk buyers"),
        ("MEDIUM", "general stock"), ("PROMO", "small stock"),
        ("STANDARD", "rare stock"), ("SMALL", "open stock")]
P3 = ["early (1995-1997)", "late (1998-2000)", "2001"]
P2 = ["before (1995-2000)", "2001"]
P3_CASE = ("CASE WHEN year <= 1997 THEN 'early (1995-1997)' "
           "WHEN year >= 1998 AND year <= 2000 THEN 'late (1998-2000)' "
           "WHEN year >= 2001 AND year <= 2001 THEN '2001' END")
P2_CASE = ("CASE WHEN year <= 2000 THEN 'before (1995-2000)' "
           "WHEN year >= 2001 AND year <= 2001 THEN '2001' END")
ORDER_NS = ["MIDDLE EAST", "EUROPE", "ASIA", "AMERICA", "AFRICA"]


def _factor(col: str, levels: list[str], labels: list[str] | None = None, out: str | None = None) -> str:
    labels = labels or levels
    out = out or col
    lab = _case(col, list(zip(levels, labels)))
    ordc = _case(col, [(lv, i) for i, lv in enumerate(levels, start=1)])
    return f"{lab} AS {out}, {ordc} AS {out}_ord"


def _band(lat: str) -> str:
    r = f"round_even({lat}, 0)"
    return (f"CASE WHEN ({r} >= 26.0) IS NULL THEN NULL WHEN {r} >= 26.0 THEN '26 and above' "
            f"ELSE 'below 26' END")


BRAW = """
other_t AS (
  SELECT year, region, protection_level, reef, depth, transect,
         CASE WHEN count(*) = count(biomass) THEN sum(biomass) END AS biomass
  FROM fish WHERE region <> 'EUROPE'
  GROUP BY year, region, protection_level, reef, depth, transect
),
other AS (
  SELECT year, region, protection_level, reef,
         CASE WHEN count(*) = count(biomass) THEN avg(biomass) END AS biomass
  FROM other_t GROUP BY year, region, protection_level, reef
),
one AS (
  SELECT year, region, protection_level, reef, depth, transect,
         CASE WHEN count(*) = count(biomass) THEN sum(biomass) END AS biomass
  FROM fish WHERE region = 'EUROPE'
  GROUP BY year, region, protection_level, reef, depth, transect
),
braw AS (
  SELECT year, region, protection_level, reef, biomass, CAST(NULL AS VARCHAR) AS depth,
         CAST(NULL AS INTEGER) AS transect FROM other
  UNION ALL
  SELECT year, region, protection_level, reef, biomass, depth, transect FROM one
)"""

INV = """
inv AS (
  SELECT * FROM survey
  WHERE label = 'O' AND coalesce(region IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE'), false)
)"""

TAXA = """
invt AS (
  SELECT *, CASE WHEN taxa3 = 'Brand#1' THEN 'Brand#1' WHEN taxa3 = 'Brand#2' THEN 'Brand#2'
                 WHEN taxa2 = 'SMALL' THEN 'SMALL' WHEN taxa2 = 'LARGE' THEN 'LARGE' END AS taxa
  FROM inv
),
invt2 AS (SELECT * FROM invt WHERE coalesce(taxa IN ('Brand#1', 'Brand#2', 'SMALL', 'LARGE'), false))"""


def _trend(src: str, keys: str, value: str, sd_n: bool = False) -> str:
    if sd_n:
        return (f"SELECT {keys}, round(avg({value}), 6) AS mean_{value}, "
                f"round(stddev_samp({value}), 6) AS sd_{value}, count(*) AS n, "
                f"round(stddev_samp({value}) / sqrt(count(*)), 6) AS se_{value} "
                f"FROM {src} GROUP BY {keys}")
    return (f"SELECT {keys}, round(avg({value}), 6) AS mean_{value}, "
            f"round(stddev_samp({value}) / sqrt(count(*)), 6) AS se_{value} "
            f"FROM {src} GROUP BY {keys}")


def _trend_cte(name: str, src: str, keys: str, value: str) -> str:
    return (f"{name} AS (SELECT {keys}, avg({value}) AS mean_{value}, "
            f"stddev_samp({value}) / sqrt(count(*)) AS se_{value} FROM {src} GROUP BY {keys})")


SQL: dict[str, str] = {}

# --- D1 on events ---------------------------------------------------------------------
EV = """
ev AS (SELECT event_id, event_type, value FROM events),
evq AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
        FROM ev GROUP BY event_type),
evf AS (
  SELECT e.*, q.q1, q.q3, q.q3 - q.q1 AS iqr, q.q1 - 1.5 * (q.q3 - q.q1) AS lower_bound,
         q.q3 + 1.5 * (q.q3 - q.q1) AS upper_bound,
         (e.value < q.q1 - 1.5 * (q.q3 - q.q1)) OR (e.value > q.q3 + 1.5 * (q.q3 - q.q1))
           AS size_flagged_outlier
  FROM ev e LEFT JOIN evq q ON e.event_type IS NOT DISTINCT FROM q.event_type
)"""
SQL["size_outliers_events"] = with_ctes(EV) + """
SELECT event_id, event_type, round(value, 6) AS value, round(q1, 6) AS q1, round(q3, 6) AS q3,
       round(iqr, 6) AS iqr, round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound,
       size_flagged_outlier
FROM evf WHERE NOT size_flagged_outlier"""
SQL["size_flags_events"] = with_ctes(EV) + """
SELECT event_type, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lower_bound, 6) AS lower_bound,
       round(upper_bound, 6) AS upper_bound, count(*) AS n,
       CAST(sum(CAST(size_flagged_outlier AS INTEGER)) AS BIGINT) AS n_flagged
FROM evf GROUP BY event_type, q1, q3, lower_bound, upper_bound"""

# --- fish -------------------------------------------------------------------------------
FISH_COLS = SURVEY_COLS + ["commercial", "functional_name", "q1", "q3", "iqr", "lower_bound",
                           "upper_bound", "size_flagged_outlier"]
SQL["fish_productivity"] = with_ctes(VIEW, FISH) + f"""
SELECT {_sel(FISH_COLS, FISH_COLS_DBL)} FROM fish"""

SQL["biomass_raw"] = with_ctes(VIEW, FISH, BRAW) + """
SELECT year, region, protection_level, reef, round(biomass, 6) AS biomass, depth, transect FROM braw"""

SQL["balanced_biomass"] = with_ctes(VIEW, FISH, BRAW, sites_cte("braw", "bal")) + """
SELECT year, region, protection_level, reef, round(biomass, 6) AS biomass, depth, transect FROM bal"""

SQL["balanced_biomass_site_counts"] = with_ctes(VIEW, FISH, BRAW, sites_cte("braw", "bal")) + """
SELECT region, count(*) AS site_count FROM bal_kept GROUP BY region"""

SQL["balanced_biomass_selection"] = with_ctes(VIEW, FISH, BRAW, sites_cte("braw", "bal")) + """
SELECT (SELECT t FROM bal_total) AS total_years, round(min(mx), 6) AS min_max_coverage,
       CAST(ceil(min(mx) * (SELECT t FROM bal_total)) AS BIGINT) AS threshold
FROM (SELECT region, max(coverage) AS mx FROM bal_sites GROUP BY region)"""

SQL["biomass_by_region"] = with_ctes(VIEW, FISH, BRAW, sites_cte("braw", "bal")) + "\n" + _trend(
    "bal", "year, region", "biomass", sd_n=True)

SQL["biomass_by_protection"] = with_ctes(
    VIEW, FISH, BRAW, sites_cte("braw", "bal"),
    _trend_cte("bp", "bal", "year, protection_level", "biomass")) + f"""
SELECT year, {_factor('protection_level', [k for k, _ in PROT], [v for _, v in PROT])},
       round(mean_biomass, 6) AS mean_biomass, round(se_biomass, 6) AS se_biomass FROM bp"""

BF = reef_mean_cte("fish", "bfr", "biomass", ("functional_name",), strict=True)
SQL["biomass_functional_reef"] = with_ctes(VIEW, FISH, BF, sites_cte("bfr", "bfb")) + """
SELECT year, region, protection_level, reef, functional_name, round(biomass, 6) AS biomass FROM bfb"""

SQL["biomass_by_functional"] = with_ctes(
    VIEW, FISH, BF, sites_cte("bfr", "bfb"),
    _trend_cte("bpf", "bfb", "year, region, protection_level, functional_name", "biomass")) + f"""
SELECT year, region, {_factor('protection_level', [k for k, _ in PROT], [v for _, v in PROT])},
       functional_name, round(mean_biomass, 6) AS mean_biomass, round(se_biomass, 6) AS se_biomass
FROM bpf"""

SPP = reef_mean_cte("fish", "spp", "biomass", ("functional_name", "species"))
BF3 = f"bf3 AS (SELECT *, {P3_CASE} AS period FROM spp_bal)"
BF2 = f"bf2 AS (SELECT *, {P2_CASE} AS period FROM spp_bal)"
FUNC_LOOKUP = "sfun AS (SELECT DISTINCT species, functional_name FROM bf3)"

SQL["fish_species_reef"] = with_ctes(VIEW, FISH, SPP, sites_cte("spp", "spp_bal"), BF3) + """
SELECT year, region, protection_level, reef, functional_name, species, round(biomass, 6) AS biomass,
       period FROM bf3"""

SQL["species_functional"] = with_ctes(
    VIEW, FISH, SPP, sites_cte("spp", "spp_bal"), BF3, FUNC_LOOKUP) + """
SELECT species, functional_name FROM sfun"""


def _top_fish(src: str, band: str, levels: list[str]) -> str:
    other = "below 26" if band == "north" else "26 and above"
    return f"""
tx AS (
  SELECT b.*, l.lat, {_band('l.lat')} AS degree
  FROM {src} b LEFT JOIN lats l ON b.region IS NOT DISTINCT FROM l.region
),
tx2 AS (
  SELECT * FROM tx
  WHERE NOT coalesce(region IN ('AMERICA'), false) AND functional_name IS NOT NULL
    AND degree <> '{other}' AND functional_name <> 'SMALL'
),
tm AS (SELECT period, species, avg(biomass) AS biomass FROM tx2 GROUP BY period, species),
tm2 AS (SELECT {_factor('period', levels)}, species, biomass FROM tm),
ttot AS (SELECT period, coalesce(sum(biomass), 0) AS total_biomass FROM tm2 GROUP BY period),
trk AS (
  SELECT *, rank() OVER (PARTITION BY period ORDER BY biomass DESC) AS rk
  FROM tm2 WHERE biomass IS NOT NULL
),
ttop AS (
  SELECT r.period, r.species, r.biomass, r.period_ord, t.total_biomass,
         CASE WHEN t.total_biomass = 0 THEN NULL ELSE r.biomass / t.total_biomass END * 100
           AS rel_biomass
  FROM trk r LEFT JOIN ttot t ON r.period IS NOT DISTINCT FROM t.period WHERE r.rk <= 10
),
tj AS (
  SELECT t.*, f.functional_name AS fn FROM ttop t
  LEFT JOIN sfun f ON t.species IS NOT DISTINCT FROM f.species
),
tj2 AS (
  SELECT period, species, biomass, period_ord, total_biomass, rel_biomass,
         {_factor('fn', [k for k, _ in FUNC], [v for _, v in FUNC], out='functional_name')}
  FROM tj
),
tj3 AS (
  SELECT *, coalesce(species, 'NA') || '___' || coalesce(period, 'NA') AS species_key
  FROM tj2 WHERE functional_name <> 'open stock'
),
tj4 AS (SELECT *, avg(rel_biomass) OVER (PARTITION BY period, species_key) AS m FROM tj3)"""


TOP_FISH_OUT = """
SELECT period, species, round(biomass, 6) AS biomass, period_ord, round(total_biomass, 6) AS total_biomass,
       round(rel_biomass, 6) AS rel_biomass, functional_name, functional_name_ord, species_key,
       CAST(dense_rank() OVER (PARTITION BY period ORDER BY m ASC NULLS LAST, species_key) AS INTEGER)
         AS species_ord
FROM tj4"""

for _band_name, _scheme in (("north", 3), ("south", 3), ("north", 2), ("south", 2)):
    SQL[f"top_fish_{_band_name}_{_scheme}p"] = with_ctes(
        VIEW, FISH, SPP, sites_cte("spp", "spp_bal"), BF3, BF2, FUNC_LOOKUP,
        _top_fish(f"bf{_scheme}", _band_name, P3 if _scheme == 3 else P2)) + TOP_FISH_OUT

# --- invertebrates ----------------------------------------------------------------------
SQL["invertebrates"] = with_ctes(VIEW, INV) + f"""
SELECT {_sel(SURVEY_COLS, SURVEY_DBL)} FROM inv"""

CORAL = reef_mean_cte("inv", "coral", "quantity", ("taxa3",),
                      where="coalesce(taxa3 IN ('Brand#1', 'Brand#2'), false)")
SQL["coral_reef"] = with_ctes(VIEW, INV, CORAL) + """
SELECT year, region, protection_level, reef, taxa3, round(quantity, 6) AS quantity FROM coral"""
SQL["balanced_coral"] = with_ctes(VIEW, INV, CORAL, sites_cte("coral", "cbal")) + """
SELECT year, region, protection_level, reef, taxa3, round(quantity, 6) AS quantity FROM cbal"""
SQL["coral_by_region"] = with_ctes(VIEW, INV, CORAL, sites_cte("coral", "cbal")) + "\n" + _trend(
    "cbal", "year, region, taxa3", "quantity")
SQL["coral_by_protection"] = with_ctes(VIEW, INV, CORAL, sites_cte("coral", "cbal")) + "\n" + _trend(
    "cbal", "year, protection_level, taxa3", "quantity")


def _linear(src: str, keys: str) -> str:
    return f"""
SELECT {keys}, CASE WHEN count(DISTINCT CASE WHEN mean_quantity IS NOT NULL THEN year END) > 1 THEN round(regr_slope(mean_quantity, CAST(year AS DOUBLE)), 6) END AS slope,
       CASE WHEN count(DISTINCT CASE WHEN mean_quantity IS NOT NULL THEN year END) > 1 THEN round(regr_intercept(mean_quantity, CAST(year AS DOUBLE)), 6) END AS intercept,
       CASE WHEN count(DISTINCT CASE WHEN mean_quantity IS NOT NULL THEN year END) > 1 THEN round(regr_r2(mean_quantity, CAST(year AS DOUBLE)), 6) END AS r2,
       CAST(regr_count(mean_quantity, CAST(year AS DOUBLE)) AS BIGINT) AS n_points
FROM {src} GROUP BY {keys}"""


SQL["coral_trend_region_linear"] = with_ctes(
    VIEW, INV, CORAL, sites_cte("coral", "cbal"),
    _trend_cte("cbr", "cbal", "year, region, taxa3", "quantity")) + _linear("cbr", "region, taxa3")
SQL["coral_trend_protection_linear"] = with_ctes(
    VIEW, INV, CORAL, sites_cte("coral", "cbal"),
    _trend_cte("cbp", "cbal", "year, protection_level, taxa3", "quantity")) + _linear(
    "cbp", "protection_level, taxa3")

ECH = reef_mean_cte("inv", "ech", "quantity", ("taxa2",),
                    where="coalesce(taxa2 IN ('SMALL', 'LARGE'), false)")
SQL["echinoderm_reef"] = with_ctes(VIEW, INV, ECH, sites_cte("ech", "ebal")) + """
SELECT year, region, protection_level, reef, taxa2, round(quantity, 6) AS quantity FROM ebal"""
SQL["echinoderm_by_region"] = with_ctes(VIEW, INV, ECH, sites_cte("ech", "ebal")) + "\n" + _trend(
    "ebal", "year, region, taxa2", "quantity")
SQL["echinoderm_by_protection"] = with_ctes(VIEW, INV, ECH, sites_cte("ech", "ebal")) + "\n" + _trend(
    "ebal", "year, protection_level, taxa2", "quantity")

IAB = reef_mean_cte("invt2", "iab", "quantity", ("taxa",))
IBR = _trend_cte("ibr", "iab_bal", "year, region, taxa", "quantity")
SQL["invertebrates_by_region"] = with_ctes(VIEW, INV, TAXA, IAB, sites_cte("iab", "iab_bal")) + "\n" + \
    _trend("iab_bal", "year, region, taxa", "quantity")

BARS = """
bx AS (
  SELECT b.*, l.lat FROM (SELECT * FROM ibr WHERE year = 2001) b
  LEFT JOIN lats l ON b.region IS NOT DISTINCT FROM l.region
),
brank AS (
  SELECT region, CAST(dense_rank() OVER (ORDER BY m ASC NULLS LAST, region) AS INTEGER) AS region_ord
  FROM (SELECT region, avg(-lat) AS m FROM bx GROUP BY region)
),
bx2 AS (SELECT x.*, r.region_ord FROM bx x LEFT JOIN brank r ON x.region IS NOT DISTINCT FROM r.region)"""
SQL["inv_bars_absolute"] = with_ctes(VIEW, INV, TAXA, IAB, sites_cte("iab", "iab_bal"), IBR, BARS) + """
SELECT year, region, taxa, round(mean_quantity, 6) AS mean_quantity, round(se_quantity, 6) AS se_quantity,
       round(lat, 6) AS lat, region_ord,
       round(sum(mean_quantity) OVER (PARTITION BY region ORDER BY taxa DESC NULLS FIRST
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS ymax,
       round(sum(mean_quantity) OVER (PARTITION BY region ORDER BY taxa DESC NULLS FIRST
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             - mean_quantity, 6) + 0.0 AS ymin
FROM bx2"""
SQL["inv_bars_relative"] = with_ctes(VIEW, INV, TAXA, IAB, sites_cte("iab", "iab_bal"), IBR, BARS) + """
SELECT year, region, taxa, round(mean_quantity, 6) AS mean_quantity, round(se_quantity, 6) AS se_quantity,
       round(lat, 6) AS lat, region_ord,
       round(CASE WHEN sum(mean_quantity) OVER (PARTITION BY region) = 0 THEN NULL
                  ELSE mean_quantity / sum(mean_quantity) OVER (PARTITION BY region) END, 6) AS share
FROM bx2"""

ISPP = """
ispp_src AS (
  SELECT year, region, protection_level, reef, depth, transect, taxa, quantity,
         CASE WHEN contains(species, 'widget') THEN 'widget sp' ELSE species END AS species
  FROM invt2
)""" + "," + reef_mean_cte("ispp_src", "ispp", "quantity", ("taxa", "species"))
BINV = f"binv AS (SELECT *, {P3_CASE} AS period FROM ispp_bal)"
SQL["inv_species_reef"] = with_ctes(VIEW, INV, TAXA, ISPP, sites_cte("ispp", "ispp_bal"), BINV) + """
SELECT year, region, protection_level, reef, taxa, species, round(quantity, 6) AS quantity, period
FROM binv"""
SQL["species_taxa"] = with_ctes(VIEW, INV, TAXA, ISPP, sites_cte("ispp", "ispp_bal"), BINV) + """
SELECT DISTINCT taxa, species FROM binv"""


def _top_inv(band: str) -> str:
    other = "below 26" if band == "north" else "26 and above"
    return f"""
ux AS (
  SELECT b.*, l.lat, {_band('l.lat')} AS degree
  FROM binv b LEFT JOIN lats l ON b.region IS NOT DISTINCT FROM l.region
),
ux2 AS (
  SELECT {_factor('period', P3)}, taxa,
         CASE WHEN contains(species, 'bolt') IS NULL THEN NULL
              WHEN contains(species, 'bolt') THEN 'bolt sp' ELSE species END AS species,
         quantity
  FROM ux WHERE NOT coalesce(region IN ('AMERICA'), false) AND degree <> '{other}'
),
um AS (
  SELECT period, period_ord, taxa, species, avg(quantity) AS quantity
  FROM ux2 GROUP BY period, period_ord, taxa, species
),
urk AS (
  SELECT *, rank() OVER (PARTITION BY period ORDER BY quantity DESC) AS rk
  FROM um WHERE quantity IS NOT NULL
),
utop AS (
  SELECT period, period_ord, taxa, species, quantity,
         coalesce(species, 'NA') || '___' || coalesce(period, 'NA') AS species_key
  FROM urk WHERE rk <= 10
),
utop2 AS (SELECT *, avg(quantity) OVER (PARTITION BY period, species_key) AS m FROM utop)"""


for _b, _name in (("south", "top_inv_south"), ("north", "top_inv_north")):
    SQL[_name] = with_ctes(VIEW, INV, TAXA, ISPP, sites_cte("ispp", "ispp_bal"), BINV, _top_inv(_b)) + """
SELECT period, period_ord, taxa, species, round(quantity, 6) AS quantity, species_key,
       CAST(dense_rank() OVER (PARTITION BY period ORDER BY m ASC NULLS LAST, species_key) AS INTEGER)
         AS species_ord
FROM utop2"""

# --- diversity --------------------------------------------------------------------------
RICH = """
rsrc AS (
  SELECT * FROM survey
  WHERE coalesce(taxa2 IN ('SMALL', 'LARGE'), false) OR coalesce(taxa3 IN ('Brand#1', 'Brand#2'), false)
     OR label = 'F'
),
rt AS (
  SELECT year, region, protection_level, reef, depth, transect, label,
         count(DISTINCT species) + max(CASE WHEN species IS NULL THEN 1 ELSE 0 END) AS richness
  FROM rsrc GROUP BY year, region, protection_level, reef, depth, transect, label
),
rr AS (
  SELECT year, region, protection_level, reef, label,
         CASE WHEN count(*) = count(richness) THEN avg(richness) END AS richness
  FROM rt GROUP BY year, region, protection_level, reef, label
)"""
SQL["richness_reef"] = with_ctes(VIEW, RICH, sites_cte("rr", "rbal")) + """
SELECT year, region, protection_level, reef, label, round(richness, 6) AS richness FROM rbal"""
SQL["richness_by_region"] = with_ctes(VIEW, RICH, sites_cte("rr", "rbal")) + "\n" + _trend(
    "rbal", "year, region, label", "richness")
SQL["richness_history"] = with_ctes(
    VIEW, RICH, sites_cte("rr", "rbal"), _trend_cte("rbr", "rbal", "year, region, label", "richness"),
    """
h AS (
  SELECT *, CASE WHEN year IS NULL THEN NULL WHEN year < 2001 THEN 'before' ELSE '2001' END AS cat
  FROM rbr WHERE coalesce(region IN ('AFRICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'), false)
),
h2 AS (SELECT *, """ + _factor("cat", ["before", "2001"], out="category") + """ FROM h),
hm AS (
  SELECT category, category_ord, region, label, avg(mean_richness) AS richness
  FROM h2 GROUP BY category, category_ord, region, label
),
hm2 AS (
  SELECT m.*, l.lat FROM (SELECT * FROM hm WHERE label = 'O') m
  LEFT JOIN lats l ON m.region IS NOT DISTINCT FROM l.region
),
hrank AS (
  SELECT region, CAST(dense_rank() OVER (ORDER BY m ASC NULLS LAST, region) AS INTEGER) AS region_ord
  FROM (SELECT region, avg(richness) AS m FROM hm2 GROUP BY region)
)""") + """
SELECT h.category, h.category_ord, h.region, h.label, round(h.richness, 6) AS richness,
       round(h.lat, 6) AS lat, r.region_ord
FROM hm2 h LEFT JOIN hrank r ON h.region IS NOT DISTINCT FROM r.region"""

SQL["shannon_by_transect"] = with_ctes(VIEW, """
sq AS (
  SELECT region, reef, transect, species, coalesce(sum(quantity), 0) AS q
  FROM survey WHERE quantity IS NOT NULL AND species IS NOT NULL
  GROUP BY region, reef, transect, species
),
st AS (SELECT *, sum(q) OVER (PARTITION BY region, reef, transect) AS t FROM sq)""") + """
SELECT concat_ws('_', coalesce(region, 'NA'), coalesce(reef, 'NA'), coalesce(CAST(transect AS VARCHAR), 'NA'))
         AS transect_id,
       region, reef, transect,
       round(coalesce(0.0 - sum(CASE WHEN q > 0 THEN (q / t) * ln(q / t) END), 0.0), 6) AS shannon_index
FROM st GROUP BY region, reef, transect"""

# --- chart tables -----------------------------------------------------------------------
SQL["chart_biomass_region"] = with_ctes(
    VIEW, FISH, BRAW, sites_cte("braw", "bal"),
    """
br AS (
  SELECT year, region, avg(biomass) AS mean_biomass, stddev_samp(biomass) AS sd_biomass, count(*) AS n,
         stddev_samp(biomass) / sqrt(count(*)) AS se_biomass
  FROM bal GROUP BY year, region
)""") + """
SELECT year, region, round(mean_biomass, 6) AS mean_biomass, round(sd_biomass, 6) AS sd_biomass, n,
       round(se_biomass, 6) AS se_biomass, round(mean_biomass - se_biomass, 6) + 0.0 AS ymin,
       round(mean_biomass + se_biomass, 6) AS ymax, CAST(4.0 AS DOUBLE) AS reference_line
FROM br WHERE NOT coalesce(region IN ('AMERICA'), false)"""

SQL["chart_biomass_protection"] = with_ctes(
    VIEW, FISH, BRAW, sites_cte("braw", "bal"),
    _trend_cte("bp", "bal", "year, protection_level", "biomass")) + f"""
SELECT year, {_factor('protection_level', [k for k, _ in PROT], [v for _, v in PROT])},
       round(mean_biomass, 6) AS mean_biomass, round(se_biomass, 6) AS se_biomass,
       round(mean_biomass - se_biomass, 6) + 0.0 AS ymin, round(mean_biomass + se_biomass, 6) AS ymax,
       CAST(4.0 AS DOUBLE) AS reference_line
FROM bp"""

SQL["chart_coral_region"] = with_ctes(
    VIEW, INV, CORAL, sites_cte("coral", "cbal"),
    _trend_cte("cbr", "cbal", "year, region, taxa3", "quantity"),
    f"""
cr AS (
  SELECT c.year, {_factor('c.region', ORDER_NS, out='region')}, c.taxa3, c.mean_quantity, c.se_quantity,
         l.lat
  FROM cbr c LEFT JOIN lats l ON c.region IS NOT DISTINCT FROM l.region
)""") + """
SELECT year, region, region_ord, taxa3, round(mean_quantity, 6) AS mean_quantity,
       round(se_quantity, 6) AS se_quantity, round(lat, 6) AS lat,
       round(mean_quantity - se_quantity, 6) + 0.0 AS ymin, round(mean_quantity + se_quantity, 6) AS ymax
FROM cr WHERE NOT coalesce(region IN ('AMERICA'), false)"""

SQL["chart_coral_protection"] = with_ctes(
    VIEW, INV, CORAL, sites_cte("coral", "cbal"),
    _trend_cte("cbp", "cbal", "year, protection_level, taxa3", "quantity")) + """
SELECT year, protection_level, taxa3, round(mean_quantity, 6) AS mean_quantity,
       round(se_quantity, 6) AS se_quantity,
       round(mean_quantity - se_quantity, 6) + 0.0 AS ymin, round(mean_quantity + se_quantity, 6) AS ymax
FROM cbp"""

SQL["chart_echinoderm_log"] = with_ctes(
    VIEW, INV, ECH, sites_cte("ech", "ebal"),
    _trend_cte("ebr", "ebal", "year, region, taxa2", "quantity"),
    f"""
er AS (
  SELECT e.year, {_factor('e.region', ORDER_NS, out='region')}, e.taxa2, e.mean_quantity, e.se_quantity,
         l.lat
  FROM ebr e LEFT JOIN lats l ON e.region IS NOT DISTINCT FROM l.region
),
er2 AS (
  SELECT *, ln(1 + mean_quantity) AS log_quan, ln(1 + se_quantity) AS se_log
  FROM er WHERE NOT coalesce(region IN ('AMERICA'), false)
)""") + """
SELECT year, region, region_ord, taxa2, round(mean_quantity, 6) AS mean_quantity,
       round(se_quantity, 6) AS se_quantity, round(lat, 6) AS lat, round(log_quan, 6) AS log_quan,
       round(se_log, 6) AS se_log, round(log_quan - se_log, 6) + 0.0 AS ymin, round(log_quan + se_log, 6) AS ymax
FROM er2"""


def _banded(north: str, south: str) -> str:
    return (f"SELECT *, '26 and above' AS band FROM ({north}) "
            f"UNION ALL SELECT *, 'below 26' AS band FROM ({south})")


SQL["chart_top_fish_3p"] = _banded(SQL["top_fish_north_3p"], SQL["top_fish_south_3p"])
SQL["chart_top_inv"] = _banded(SQL["top_inv_north"], SQL["top_inv_south"])
SQL["chart_top_fish_2p"] = _banded(SQL["top_fish_north_2p"], SQL["top_fish_south_2p"])

# --- operators on their own ---------------------------------------------------------------
SQL["survey_combined"] = with_ctes(VIEW) + """
SELECT * REPLACE (round(size, 6) AS size, round(biomass, 6) AS biomass) FROM survey"""

SQL["biomass_site_coverage"] = with_ctes(VIEW, FISH, BRAW, sites_cte("braw", "bal")) + """
SELECT region, reef, years_monitored, round(coverage, 6) AS coverage FROM bal_sites"""

SQL["balanced_biomass_min_years"] = with_ctes(VIEW, FISH, BRAW, sites_cte("braw", "bal", "3")) + """
SELECT year, region, protection_level, reef, round(biomass, 6) AS biomass, depth, transect FROM bal"""

SQL["shannon_by_transect_matrix"] = with_ctes(VIEW, """
known AS (SELECT * FROM survey WHERE quantity IS NOT NULL AND species IS NOT NULL),
sq AS (
  SELECT region, reef, transect, species, coalesce(sum(quantity), 0) AS q FROM known GROUP BY ALL
  UNION ALL SELECT DISTINCT region, reef, transect, '__unit', CAST(transect AS DOUBLE) FROM known
),
st AS (SELECT *, sum(q) OVER (PARTITION BY region, reef, transect) AS t FROM sq)""") + """
SELECT concat_ws('_', coalesce(region, 'NA'), coalesce(reef, 'NA'), coalesce(CAST(transect AS VARCHAR), 'NA'))
         AS transect_id,
       region, reef, transect,
       round(coalesce(0.0 - sum(CASE WHEN q > 0 THEN (q / t) * ln(q / t) END), 0.0), 6) AS shannon_index
FROM st GROUP BY region, reef, transect"""

SQL["quantity_by_taxa_wide"] = with_ctes(VIEW) + """
SELECT region, protection_level, """ + ", ".join(
    f"CASE WHEN count(*) FILTER (taxa2 = '{t}') = 0 THEN 0 ELSE sum(quantity) FILTER (taxa2 = '{t}') END AS \"{t}\""
    for t in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")) + """,
       CASE WHEN count(*) FILTER (taxa2 IS NULL) = 0 THEN 0 ELSE sum(quantity) FILTER (taxa2 IS NULL) END AS "NA"
FROM survey GROUP BY region, protection_level"""

SQL["biomass_raw_union"] = with_ctes(VIEW, FISH, reef_mean_cte("fish", "other", "biomass", strict=True, where="region <> 'EUROPE'"),
                                     reef_mean_cte("fish", "one", "biomass", strict=True, where="region = 'EUROPE'")) + """
SELECT year, region, protection_level, reef, round(biomass, 6) AS biomass, NULL AS depth, NULL::INTEGER AS transect FROM other
UNION ALL SELECT year, region, protection_level, reef, round(biomass, 6), depth, transect FROM one_t"""

SQL["biomass_site_report"] = with_ctes(VIEW, FISH, BRAW, sites_cte("braw", "bal")) + """
SELECT region, reef, years_monitored, round(coverage, 6) AS coverage,
       rank() OVER (PARTITION BY region ORDER BY years_monitored DESC) AS place,
       dense_rank() OVER (ORDER BY region NULLS LAST) AS region_ord FROM bal_sites"""

SQL["sargassum_export"] = with_ctes(VIEW) + """
SELECT * EXCLUDE (early) REPLACE (round(size, 6) AS size, round(biomass, 6) AS biomass), round_even(latitude, 0) AS degree
FROM raw WHERE early"""

SQL["traits_csv"] = """
SELECT p_name || ' ' || p_partkey AS species, CASE WHEN p_partkey % 7 <> 1 THEN p_brand END AS groups_new, p_brand AS groups_old,
       CASE WHEN p_partkey % 11 <> 2 THEN p_type END AS functional_name, 'a "quoted", part of ' || p_size AS diet,
       CASE WHEN p_partkey % 13 <> 3 AND p_partkey % 17 <> 4 THEN p_size / 8 END AS trophic_level,
       CASE WHEN p_partkey % 19 <> 5 AND p_partkey % 23 <> 6 THEN CAST(p_size AS INTEGER) END AS max_size_tl,
       p_type AS reef_position, 'Picker' AS feeding_type, CAST(p_partkey % 2 = 0 AS INTEGER) AS solitary,
       CAST(p_partkey % 3 = 0 AS INTEGER) AS schooling, CASE WHEN p_partkey % 29 <> 7 THEN CAST(p_partkey % 5 = 0 AS INTEGER) END AS shoaling,
       CAST(p_partkey % 9 AS INTEGER) AS "cluster", p_size / 4 - 5 AS pc1, CASE WHEN p_partkey % 31 <> 8 THEN -p_size / 2 END AS pc2
FROM part"""


# --- spline fits ----------------------------------------------------------------------------
#: Basis size of the fits, ``Profile.gam_k``.
OBSERVATION_K = 10


def _f_tail(src: str, out: str) -> str:
    """``src`` with ``p = P(F > f_)`` for degrees of freedom ``d1_`` and ``d2_``; NULL where ``f_`` is.

    The regularised incomplete beta function by its continued fraction, from the 400th term up.
    """
    return f"""
{out}_x AS (SELECT *, d2_ / (d2_ + d1_ * f_) AS x_, d2_ / 2 AS a_, d1_ / 2 AS b_ FROM {src}),
{out}_s AS (
  SELECT * REPLACE (CASE WHEN s_ THEN 1 - x_ ELSE x_ END AS x_, CASE WHEN s_ THEN b_ ELSE a_ END AS a_, CASE WHEN s_ THEN a_ ELSE b_ END AS b_)
  FROM (SELECT *, x_ > (a_ + 1) / (a_ + b_ + 2) AS s_ FROM {out}_x)
),
{out}_c AS (
  SELECT *, list_reduce(list_concat([1.0::DOUBLE], list_transform(range(400, 0, -1), lambda i: i::DOUBLE)), lambda c, i:
      1 + (CASE WHEN i % 2 = 1 THEN -(a_ + floor(i / 2)) * (a_ + b_ + floor(i / 2)) / ((a_ + 2 * floor(i / 2)) * (a_ + 2 * floor(i / 2) + 1))
           ELSE floor(i / 2) * (b_ - floor(i / 2)) / ((a_ + 2 * floor(i / 2) - 1) * (a_ + 2 * floor(i / 2))) END) * x_ / c) AS c_
  FROM {out}_s
),
{out}_p AS (
  SELECT *, CASE WHEN f_ IS NULL THEN NULL WHEN x_ <= 0 THEN 0.0 WHEN x_ >= 1 THEN 1.0
    ELSE exp(a_ * ln(x_) + b_ * ln(1 - x_) - lgamma(a_) - lgamma(b_) + lgamma(a_ + b_)) / (a_ * c_) END AS part_ FROM {out}_c
),
{out} AS (SELECT * EXCLUDE (x_, a_, b_, s_, c_, part_), CASE WHEN s_ THEN 1 - part_ ELSE part_ END AS p FROM {out}_p)"""


#: One choice of the parameter per series and the price of a degree of freedom; near ties go to the larger penalty.
_PICK = """(
    SELECT {carry}, {keys}, max_by(rss, coalesce(lam, 0)) AS rss, max_by(edf, coalesce(lam, 0)) AS edf
    FROM (SELECT {carry}, {keys}, lam, rss, edf, min(rss + price * edf) OVER (PARTITION BY price, {keys}) AS least FROM {prices}, cells)
    WHERE (rss + price * edf) * (1 - 1e-6) <= least GROUP BY {carry}, {keys})"""


def _spline(src: str, keys: str, k: int = OBSERVATION_K, joint: bool = False) -> str:
    """The penalised fits of D11 as CTEs: ``fits`` has one row per series, ``pts`` the points.

    Normal equations by plain sums over the basis values of the points; the
    systems of all smoothing parameters are solved by Gauss-Jordan steps in a
    recursive CTE.  ``joint`` takes one score over all series, found by a
    second recursive CTE over the price of a degree of freedom.
    """
    on = lambda a, b: " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in keys.split(", "))
    key_of = lambda a: ", ".join(f"{a}.{c}" for c in keys.split(", "))
    whole = "".join(f" AND {c} IS NOT NULL" for c in keys.split(", ")) if joint else ""
    tried = _PICK.format(carry="price", keys=keys, prices="prices")
    again = _PICK.format(carry="step, v, price", keys=keys, prices="(SELECT step, v, 2 * r / (nn - e) AS price FROM search, total WHERE nn - e > 0.5)")
    if joint:
        choice = f"""
total AS (SELECT CAST(sum(n) AS DOUBLE) AS nn, sum(yy) AS ss FROM base),
cells AS (SELECT {keys}, lam, edf, rss FROM scored UNION ALL SELECT {keys}, NULL, 1.0, yy FROM base WHERE nx = 1),
prices AS (SELECT ss / nn * pow(10.0, e * 0.25) AS price FROM total, range(-12, 13) t(e)),
search AS (
  SELECT * FROM (SELECT 1 AS step, nn * r / pow(nn - e, 2) AS v, price, r, e
                 FROM (SELECT price, sum(rss) AS r, sum(edf) AS e FROM {tried} GROUP BY price), total
                 WHERE nn - e > 0.5 ORDER BY 2, price DESC LIMIT 1)
  UNION ALL
  SELECT step + 1, nn * r / pow(nn - e, 2), price, r, e
  FROM (SELECT step, v, price, sum(rss) AS r, sum(edf) AS e FROM {again} GROUP BY step, v, price), total
  WHERE nn - e > 0.5 AND nn * r / pow(nn - e, 2) < v * (1 - 1e-9)
),
price AS (SELECT price, v, r / (nn - e) AS scale, nn - e AS room FROM search, total ORDER BY step DESC LIMIT 1),
best AS (
  SELECT {keys}, max(lam) AS lam, {", ".join(f"max_by({c}, lam) AS {c}" for c in ("beta", "edf", "rss", "edf2", "hit", "lev"))}
  FROM (SELECT s.*, min(rss + price * edf) OVER (PARTITION BY {keys}) AS least, price FROM scored s, price)
  WHERE (rss + price * edf) * (1 - 1e-6) <= least GROUP BY {keys}
),
model AS (SELECT * FROM price)"""
        gcv, room, scale = "v", "room", "scale"
    else:
        choice = f"""
ranked AS (
  SELECT *, n * rss / pow(n - edf, 2) AS gcv, min(n * rss / pow(n - edf, 2)) OVER (PARTITION BY {keys}) AS least_gcv
  FROM scored WHERE n - edf > 0.5
),
best AS (
  SELECT {keys}, max(lam) AS lam, {", ".join(f"max_by({c}, lam) AS {c}" for c in ("beta", "edf", "rss", "gcv", "edf2", "hit", "lev"))}
  FROM ranked WHERE gcv * (1 - 1e-6) <= least_gcv GROUP BY {keys}
),
model AS (SELECT 1)"""
        gcv, room, scale = "b.gcv", "l.n - edf_", "CASE WHEN l.n - edf_ > 0.5 THEN rss_ / (l.n - edf_) END"
    return f"""
obs AS (SELECT {keys}, CAST(year AS DOUBLE) AS x, mean_quantity AS y FROM {src}
        WHERE year IS NOT NULL AND mean_quantity IS NOT NULL{whole}),
span AS (SELECT min(x) AS lo, max(x) AS hi FROM obs),
pts0 AS (
  SELECT *, y - avg(y) OVER (PARTITION BY {keys}) AS c, avg(y) OVER (PARTITION BY {keys}) AS mean,
         CASE WHEN hi > lo THEN (x - lo) / (hi - lo) * {k - 3} ELSE 0 END AS p FROM obs, span
),
pts1 AS (SELECT *, least(floor(p), {k - 4}) AS seg FROM pts0),
pts AS (
  SELECT *, list_transform(range(0, {k}), lambda j: CASE CAST(j - seg AS INTEGER)
      WHEN 0 THEN pow(1 - t, 3) / 6 WHEN 1 THEN (3 * pow(t, 3) - 6 * t * t + 4) / 6
      WHEN 2 THEN (-3 * pow(t, 3) + 3 * t * t + 3 * t + 1) / 6 WHEN 3 THEN pow(t, 3) / 6 ELSE 0.0 END) AS b
  FROM (SELECT *, p - seg AS t FROM pts1)
),
center AS (SELECT list(m ORDER BY j) AS mid FROM (SELECT j, avg(b[j]) AS m FROM pts, range(1, {k + 1}) t(j) GROUP BY j)),
base AS (
  SELECT {keys}, any_value(mean) AS mean, any_value(lo) AS lo, any_value(hi) AS hi, count(*) AS n, sum(c * c) AS yy,
         min(x) AS x_min, max(x) AS x_max, sum(p) AS sp, sum(p * p) AS spp, sum(p * c) AS spy,
         count(DISTINCT x) AS nx, list(b) AS bs, list(c) AS cs
  FROM pts GROUP BY {keys}
),
normal AS (
  SELECT *, list_transform(range(1, {k + 1}), lambda i: list_transform(range(1, {k + 1}), lambda j:
              list_sum(list_transform(bs, lambda b: b[i] * b[j])))) AS g,
         list_transform(range(1, {k + 1}), lambda i: list_sum(list_transform(range(1, len(bs) + 1), lambda q: bs[q][i] * cs[q]))) AS h
  FROM base
),
penalty AS (
  SELECT list_transform(range(0, {k}), lambda i: list_transform(range(0, {k}), lambda j:
           list_sum(list_transform(range(0, {k - 2}), lambda r:
             CAST((CASE i - r WHEN 0 THEN 1 WHEN 1 THEN -2 WHEN 2 THEN 1 ELSE 0 END)
             * (CASE j - r WHEN 0 THEN 1 WHEN 1 THEN -2 WHEN 2 THEN 1 ELSE 0 END) AS DOUBLE))))) AS pen
),
solve AS (
  SELECT {keys}, lam, 1 AS step, list_transform(range(1, {k + 1}), lambda i: list_concat(list_concat(list_concat(
           list_transform(range(1, {k + 1}), lambda j: g[i][j] + lam * pen[i][j]), [h[i]]), g[i]), [mid[i]])) AS m
  FROM normal, penalty, center, (SELECT pow(10.0, -4 + e * 0.25) AS lam FROM range(0, 41) t(e)) WHERE nx > 1
  UNION ALL
  SELECT {keys}, lam, step + 1, list_transform(m, lambda r, i: CASE WHEN i = step THEN piv
           ELSE list_transform(r, lambda v, j: v - r[step] * piv[j]) END)
  FROM (SELECT *, list_transform(m[step], lambda v: v / m[step][step]) AS piv FROM solve WHERE step <= {k})
),
solved AS (
  SELECT {keys}, lam, list_transform(m, lambda r: r[{k + 1}]) AS beta,
         list_sum(list_transform(range(1, {k + 1}), lambda i: m[i][{k + 1} + i])) AS edf,
         list_sum(list_transform(range(1, {k + 1}), lambda i: list_sum(
           list_transform(range(1, {k + 1}), lambda j: m[i][{k + 1} + j] * m[j][{k + 1} + i])))) AS edf2,
         list_sum(list_transform(range(1, {k + 1}), lambda i: mid[i] * m[i][{2 * k + 2}])) AS lev
  FROM solve, center WHERE step = {k + 1}
),
scored AS (
  SELECT s.*, n.n, list_sum(list_transform(range(1, {k + 1}), lambda i: s.beta[i] * n.h[i])) AS hit,
         greatest(n.yy - 2 * list_sum(list_transform(range(1, {k + 1}), lambda i: s.beta[i] * n.h[i]))
           + list_sum(list_transform(range(1, {k + 1}), lambda i: s.beta[i] * list_sum(
               list_transform(range(1, {k + 1}), lambda j: n.g[i][j] * s.beta[j])))), 0.0) AS rss
  FROM solved s JOIN normal n ON {on("s", "n")}
),{choice},
lined AS (
  SELECT *, CASE WHEN nx > 1 THEN spy / (spp - sp * sp / n) ELSE 0.0 END AS rise FROM base
),
lines AS (
  SELECT *, -rise * sp / n AS start, greatest(yy - rise * spy, 0.0) AS line_rss, (hi - lo) / {k - 3} AS width FROM lined
),
placed AS (
  SELECT l.*, b.lam AS "lambda", coalesce(b.edf, CASE WHEN nx > 1 THEN 2.0 ELSE 1.0 END) AS edf_,
         coalesce(b.edf2, CASE WHEN nx > 1 THEN 2.0 ELSE 1.0 END) AS edf2_, coalesce(b.rss, line_rss) AS rss_,
         coalesce(b.hit, yy - line_rss) AS hit_, {gcv} AS gcv, {room} AS room_, {scale} AS scale_, b.lev AS lev_,
         coalesce(b.beta, list_transform(range(0, {k}), lambda i: start + rise * (i - 1))) AS beta_
  FROM lines l LEFT JOIN best b ON {on("l", "b")} CROSS JOIN model
),
tested AS (
  SELECT *, CASE WHEN fine THEN hit_ / (scale_ * (edf_ - 1)) END AS f_, CASE WHEN fine THEN (edf_ - 1) * (edf_ - 1) / (edf2_ - 1) END AS d1_, room_ AS d2_
  FROM (SELECT *, coalesce(room_ > 0.5 AND edf_ - 1 > 1e-9 AND edf2_ - 1 > 1e-9 AND scale_ > 1e-12 * yy / n, false) AS fine FROM placed)
),{_f_tail("tested", "tails")},
fits AS (
  SELECT {keys}, n, edf_ AS edf, "lambda", gcv, CASE WHEN yy > 0 THEN 1 - rss_ / yy END AS r2, scale_ AS scale,
         CASE WHEN n - edf_ > 0.5 AND yy > 0 AND n > 1 THEN 1 - rss_ / (n - edf_) * (n - 1) / yy END AS r2_adjusted,
         f_ AS f, d1_ AS ref_df, p, mean + start - CASE WHEN width > 0 THEN rise / width ELSE 0.0 END * lo AS intercept,
         CASE WHEN width > 0 THEN rise / width ELSE 0.0 END AS slope,
         CASE WHEN nx > 1 AND n > 2 THEN sqrt(line_rss / (n - 2) / (spp - sp * sp / n)) / width END AS slope_se,
         x_min, x_max, list_transform(beta_, lambda v: v + mean) AS coefficients,
         mean + CASE WHEN nx > 1 THEN list_sum(list_transform(range(1, {k + 1}), lambda i: beta_[i] * mid[i])) ELSE 0.0 END AS level,
         sqrt(scale_ * coalesce(lev_, 1 / n)) AS level_se, rss_, yy, mean
  FROM tails, center
)"""


_FIT = ("edf", "lambda", "gcv", "r2", "scale", "intercept", "slope", "slope_se", "x_min", "x_max")


def _spline_rows(keys: str, columns: tuple[str, ...] = _FIT, coefficients: bool = True) -> str:
    cols = ", ".join(f'round("{c}", 4) AS "{c}"' for c in columns)
    more = ", list_transform(coefficients, lambda v: round(v, 4)) AS coefficients" if coefficients else ""
    return f"""
SELECT {keys}, n, {cols}{more} FROM fits"""


def _terms(a: str, b: str) -> str:
    """Treatment contrasts of the cells' levels, the reference being the least level of each factor."""
    return f""",
ends AS (SELECT min({a}) AS a0, min({b}) AS b0, CAST(sum(n) AS DOUBLE) - sum(edf) AS room FROM fits),
cell AS (SELECT {a} AS ca, {b} AS cb, level AS lv, level_se * level_se AS var FROM fits),
origin AS (SELECT a0, b0, room, (SELECT lv FROM cell WHERE ca = a0 AND cb = b0) AS lv0, (SELECT var FROM cell WHERE ca = a0 AND cb = b0) AS var0 FROM ends),
term AS (
  SELECT '(Intercept)' AS term, NULL AS "{a}", NULL AS "{b}", lv0 AS estimate, var0 AS var FROM origin
  UNION ALL
  SELECT '{a}[' || l || ']', l, NULL, lv - lv0, var + var0
  FROM (SELECT DISTINCT ca AS l FROM cell), origin LEFT JOIN cell ON ca = l AND cb = b0 WHERE l <> a0
  UNION ALL
  SELECT '{b}[' || l || ']', NULL, l, lv - lv0, var + var0
  FROM (SELECT DISTINCT cb AS l FROM cell), origin LEFT JOIN cell ON cb = l AND ca = a0 WHERE l <> b0
  UNION ALL
  SELECT '{a}[' || c.ca || ']:{b}[' || c.cb || ']', c.ca, c.cb, c.lv + lv0 - x.lv - y.lv, c.var + var0 + x.var + y.var
  FROM cell c CROSS JOIN origin LEFT JOIN cell x ON x.ca = c.ca AND x.cb = b0 LEFT JOIN cell y ON y.cb = c.cb AND y.ca = a0
  WHERE c.ca <> a0 AND c.cb <> b0
),
valued AS (SELECT *, sqrt(var) AS std_error, CASE WHEN var > 0 THEN estimate / sqrt(var) END AS t FROM term),
squared AS (SELECT *, CASE WHEN room > 0.5 THEN t * t END AS f_, 1.0 AS d1_, room AS d2_ FROM valued, origin),{_f_tail("squared", "shown")}
SELECT term, "{a}", "{b}", round(estimate, 4) AS estimate, round(std_error, 4) AS std_error, round(t, 4) AS t, round(p, 4) AS p FROM shown"""


_SUMMARY = """
SELECT terms, n, round(edf, 4) AS edf, round(gcv, 4) AS gcv, round(scale, 4) AS scale,
       round(CASE WHEN spread > 0 AND n > 1 THEN 1 - scale * (n - 1) / spread END, 4) AS r2_adjusted,
       round(CASE WHEN spread > 0 THEN 1 - rss / spread END, 4) AS deviance_explained
FROM (SELECT count(*) AS terms, CAST(sum(n) AS BIGINT) AS n, sum(edf) AS edf, any_value(gcv) AS gcv, any_value(scale) AS scale, sum(rss_) AS rss,
             sum(yy + n * mean * mean) - sum(n * mean) * sum(n * mean) / sum(n) AS spread FROM fits)"""


def _spline_fitted(src: str, keys: str, k: int = OBSERVATION_K) -> str:
    on = " AND ".join(f"s.{c} IS NOT DISTINCT FROM f.{c}" for c in keys.split(", "))
    return f"""
SELECT s.year, {", ".join("s." + c for c in keys.split(", "))}, round(s.mean_quantity, 6) AS mean_quantity,
       round(s.se_quantity, 6) AS se_quantity, round(list_sum(list_transform(range(1, {k + 1}), lambda i: f.coefficients[i] * p.b[i])), 6) AS fitted
FROM {src} s LEFT JOIN fits f ON {on}
LEFT JOIN (SELECT DISTINCT x, b FROM pts) p ON p.x = CAST(s.year AS DOUBLE)"""


_TESTS = ("edf", "f", "ref_df", "p", "r2_adjusted", "r2")

for _name, _keys, _trend_name in (("region", "region, taxa3", "cbr"), ("protection", "protection_level, taxa3", "cbp")):
    _ctes, _joint = (with_ctes(VIEW, INV, CORAL, sites_cte("coral", "cbal"),
                               _trend_cte(_trend_name, "cbal", f"year, {_keys}", "quantity"),
                               _spline(_trend_name, _keys, joint=_of_all)).replace("WITH ", "WITH RECURSIVE ", 1) for _of_all in (False, True))
    SQL[f"coral_trend_{_name}_smooth"] = _ctes + _spline_rows(_keys)
    SQL[f"coral_trend_{_name}_fitted"] = _ctes + _spline_fitted(_trend_name, _keys)
    SQL[f"coral_trend_{_name}_tests"] = _ctes + _spline_rows(_keys, _TESTS, False)
    SQL[f"coral_trend_{_name}_joint"] = _joint + _spline_rows(_keys, (*_FIT, "level", "level_se"))
    SQL[f"coral_trend_{_name}_joint_tests"] = _joint + _spline_rows(_keys, _TESTS, False)
    SQL[f"coral_trend_{_name}_joint_terms"] = _joint + _terms(*_keys.split(", "))
    SQL[f"coral_trend_{_name}_joint_summary"] = _joint + _SUMMARY

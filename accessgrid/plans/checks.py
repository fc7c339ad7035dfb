"""Shared pieces of the SQL the query results are compared with.

Every piece is written from the definition of the operator, without its search structure:
nearest is a minimum over all sites, radius a filter over all pairs, and so on.
"""
from __future__ import annotations

import re

from accessgrid.functions import constants as k
from accessgrid.plans.inputs import DIGITS, EXCLUDED_STATE
from accessgrid.sources.tables import SHAPES


def miles(a: str, b: str) -> str:
    return (
        f"2 * 3958.8 * asin(sqrt(least(1.0, pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2)"
        f" + cos(radians({a}.lat)) * cos(radians({b}.lat))"
        f" * pow(sin((radians({b}.lon) - radians({a}.lon)) / 2), 2))))"
    )


# EPSG:5070, Albers equal area on GRS80 (1/f = 298.257222101), parallels 29.5 and 45.5,
# origin 23 N 96 W: eccentricity, cone constant, C, radius of the origin.
ALBERS = (0.08181919104281579, 0.6029027690657596, 1.3491820315609697, 9928937.004248787)
SEMI_MAJOR, ORIGIN_LON = 6378137.0, -96.0


def albers(lat: str, lon: str) -> tuple[str, str]:
    e, n, c, rho0 = ALBERS
    s = f"sin(radians({lat}))"
    q = (
        f"(1 - {e!r}::DOUBLE * {e!r}::DOUBLE) * ({s} / (1 - {e!r}::DOUBLE * {e!r}::DOUBLE * {s} * {s})"
        f" - ln((1 - {e!r}::DOUBLE * {s}) / (1 + {e!r}::DOUBLE * {s})) / (2 * {e!r}::DOUBLE))"
    )
    rho = f"({SEMI_MAJOR!r}::DOUBLE / {n!r}::DOUBLE * sqrt({c!r}::DOUBLE - {n!r}::DOUBLE * {q}))"
    theta = f"({n!r}::DOUBLE * radians({lon} - ({ORIGIN_LON})))"
    return f"{rho} * sin({theta})", f"{rho0!r}::DOUBLE - {rho} * cos({theta})"


PIECES: dict[str, str] = {
    "stations": f"""
SELECT id, station_name,
       concat(upper(substr(trim(city), 1, 1)), lower(substr(trim(city), 2))) AS city,
       upper(trim(r.state)) AS state, lpad(zip, cast(greatest(5, length(zip)) AS int), '0') AS zip, latitude, longitude,
       access_code, status_code, open_date,
       coalesce(level1_ports, 0) AS level1_ports, coalesce(level2_ports, 0) AS level2_ports,
       coalesce(dcfc_ports, 0) AS dcfc_ports, trim(ev_network) AS ev_network, country,
       try_cast(open_date AS date) AS opened,
       cast(year(try_cast(open_date AS date)) AS int) AS install_year,
       cast(month(try_cast(open_date AS date)) AS int) AS install_month,
       cast(coalesce(level1_ports, 0) + coalesce(level2_ports, 0) + coalesce(dcfc_ports, 0) AS int) AS total_ports,
       CASE WHEN dcfc_ports > 0 THEN 'DCFC' WHEN level2_ports > 0 THEN 'Level2' ELSE 'Level1' END AS charger_level,
       CASE WHEN dcfc_ports > 0 THEN 1 ELSE 0 END AS is_dcfc, m.region
FROM [stations_raw] r LEFT JOIN [state_regions] m ON m.state = upper(trim(r.state))
WHERE status_code = 'E' AND access_code = 'public' AND country = 'US' AND city IS NOT NULL AND zip IS NOT NULL
  AND coalesce(level1_ports, 0) + coalesce(level2_ports, 0) + coalesce(dcfc_ports, 0) > 0
  AND upper(trim(r.state)) <> '{EXCLUDED_STATE}'""",
    "near": f"""
SELECT zone, min(d) AS nearest_miles, arg_min(site_id, d) AS nearest_id
FROM (SELECT z.zone, s.site_id, {miles('z', 's')} AS d FROM [zones] z, [sites] s)
GROUP BY zone""",
    "covered": f"""
SELECT z.*, n.nearest_miles, n.nearest_id,
       CASE WHEN n.nearest_miles > {k.DESERT_MILES} THEN 1 WHEN n.nearest_miles <= {k.DESERT_MILES} THEN 0 END AS is_desert,
       CASE WHEN n.nearest_miles > {k.DESERT_MILES} THEN '{k.DESERT_LABEL}'
            WHEN n.nearest_miles <= {k.DESERT_MILES} THEN '{k.ADEQUATE_LABEL}' ELSE '{k.UNKNOWN_LABEL}' END AS coverage_status
FROM [zones] z LEFT JOIN [near] n USING (zone)""",
    "weather": f"""
SELECT state, avg(tmean) AS avg_temp_c, avg(precip) AS avg_precip_mm_day,
       avg(CASE WHEN tmax >= {k.HEAT_DAY_C} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * {k.DAYS_PER_YEAR} AS heat_days_year,
       avg(CASE WHEN precip >= {k.HEAVY_PRECIP_MM} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * {k.DAYS_PER_YEAR} AS heavy_precip_days_year
FROM [weather_daily] GROUP BY state""",
    "monthly": """
SELECT zip AS zone, make_date(install_year, install_month, 1) AS month_start,
       cast(sum(dcfc_ports) AS double) AS new_ports, cast(sum(is_dcfc) AS double) AS new_stations
FROM [stations] WHERE install_year IS NOT NULL GROUP BY zip, install_year, install_month""",
    "months": """
SELECT cast(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS date) AS month_start
FROM (SELECT min(month_start) AS lo, max(month_start) AS hi FROM [monthly])""",
    "panel": """
SELECT z.zone, m.month_start, coalesce(e.new_ports, 0.0::DOUBLE) AS new_ports,
       coalesce(e.new_stations, 0.0::DOUBLE) AS new_stations
FROM [zones] z CROSS JOIN [months] m LEFT JOIN [monthly] e ON e.zone = z.zone AND e.month_start = m.month_start""",
    "panel_features": """
SELECT *, lag(new_ports, 1) OVER w AS ports_lag_1m,
       CASE WHEN count(*) OVER w3 = 3 THEN sum(new_ports) OVER w3 END AS ports_lag_3m,
       CASE WHEN count(*) OVER w6 = 6 THEN sum(new_ports) OVER w6 END AS ports_lag_6m,
       CASE WHEN count(*) OVER w12 = 12 THEN sum(new_ports) OVER w12 END AS ports_lag_12m,
       coalesce(sum(new_ports) OVER wc, 0.0::DOUBLE) AS ports_cum_to_date,
       CASE WHEN count(*) OVER wf = 12 THEN sum(new_ports) OVER wf END AS ports_next_12m,
       CASE WHEN row_number() OVER w >= 12 AND lead(new_ports, 1) OVER w IS NOT NULL
            THEN sum(new_ports) OVER wt END AS ports_trailing_incl_next_12m
FROM [panel]
WINDOW w AS (PARTITION BY zone ORDER BY month_start),
       w3 AS (PARTITION BY zone ORDER BY month_start ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
       w6 AS (PARTITION BY zone ORDER BY month_start ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING),
       w12 AS (PARTITION BY zone ORDER BY month_start ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING),
       wc AS (PARTITION BY zone ORDER BY month_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
       wf AS (PARTITION BY zone ORDER BY month_start ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING),
       wt AS (PARTITION BY zone ORDER BY month_start ROWS BETWEEN 10 PRECEDING AND 1 FOLLOWING)""",
    "forecasts": """
SELECT zone, ports_lag_12m AS forecast FROM [panel_features]
QUALIFY row_number() OVER (PARTITION BY zone ORDER BY month_start DESC) = 1""",
    "scored_zones": """
SELECT c.*, elevation_m / 30 AS predicted_miles, nearest_miles - elevation_m / 30 AS residual_miles,
       w.avg_temp_c, w.avg_precip_mm_day, w.heat_days_year, w.heavy_precip_days_year, f.forecast
FROM [covered] c LEFT JOIN [weather] w USING (state) LEFT JOIN [forecasts] f USING (zone)""",
    "priority": f"""
SELECT * FROM [scored_zones]
WHERE is_desert = 1 OR score >= {k.RISK_THRESHOLD}
   OR residual_miles >= (SELECT quantile_cont(residual_miles, 0.9) FROM [scored_zones])""",
    "candidates": f"""
SELECT concat(v.prefix, zone) AS candidate_id, v.kind AS candidate_type, v.hint AS rank_hint, zone AS parent_zone,
       state, region, lat + v.shift AS lat, lon, is_desert, score, residual_miles, population, income
FROM [priority],
     (SELECT * FROM (VALUES ('CENTROID_', 'zcta_centroid', 1, 0.0::DOUBLE),
                            ('OFFSETN_', 'zcta_offset_north', 2, {k.OFFSET_DEGREES}::DOUBLE),
                            ('OFFSETS_', 'zcta_offset_south', 3, -{k.OFFSET_DEGREES}::DOUBLE))
      AS t(prefix, kind, hint, shift)) v""",
    "risk": """
SELECT *, CASE WHEN hi > lo THEN (raw - lo) / (hi - lo) ELSE 0.0::DOUBLE END AS risk
FROM (SELECT *, min(raw) OVER () AS lo, max(raw) OVER () AS hi
      FROM (SELECT *, 0.5::DOUBLE * coalesce(heat_days_year, 0) + 0.5::DOUBLE * coalesce(heavy_precip_days_year, 0) AS raw
            FROM [scored_zones]))""",
    "site_coverage": f"""
SELECT candidate_id, parent_zone, region, lat, lon, sum(people) AS population_covered,
       sum(greatest(near - d, 0.0::DOUBLE)) AS distance_reduction, avg(near) AS mean_neighbor_miles,
       CASE WHEN sum(people) > 0 THEN sum(CASE WHEN low_income THEN people ELSE 0 END) / sum(people) ELSE 0.0::DOUBLE END AS equity_weight,
       avg(fc) AS avg_forecast, -avg(fc) AS market_gap_raw, avg(risk) AS weather_weight,
       ln(1 + sum(people)) AS log_population, count(*) AS covered_zones
FROM (SELECT c.candidate_id, c.parent_zone, c.region, c.lat, c.lon, coalesce(z.population, 0) AS people,
             coalesce(z.nearest_miles, 0) AS near, {miles('c', 'z')} AS d, coalesce(z.forecast, 0) AS fc, z.risk,
             coalesce(z.income, med) <= med AS low_income
      FROM [candidates] c, [risk] z, (SELECT quantile_cont(income, 0.5) AS med FROM [scored_zones]))
WHERE d <= {k.COVERAGE_MILES}
GROUP BY candidate_id, parent_zone, region, lat, lon""",
    "site_norms": f"""
SELECT *, distance_reduction / greatest(covered_zones, 1) AS reduction_per_zone,
       {', '.join(
           f"CASE WHEN max({c}) OVER () - min({c}) OVER () < 1e-9 THEN 0.0::DOUBLE"
           f" ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END AS {c}_norm"
           for c in ("log_population", "distance_reduction", "mean_neighbor_miles", "equity_weight"))},
       (rank() OVER (PARTITION BY region ORDER BY market_gap_raw)
        + (count(*) OVER (PARTITION BY region, market_gap_raw) - 1) / 2.0::DOUBLE)
       / count(*) OVER (PARTITION BY region) AS market_gap_pct
FROM [site_coverage] WHERE distance_reduction >= {k.MIN_DISTANCE_REDUCTION}""",
    "site_scores": f"""
SELECT *, score_without_market + {k.SCORE_WEIGHTS['market']}::DOUBLE * market_gap_pct AS composite_score
FROM (SELECT *, {k.SCORE_WEIGHTS['gap']}::DOUBLE * distance_reduction_norm
                + {k.SCORE_WEIGHTS['need']}::DOUBLE * mean_neighbor_miles_norm
                + {k.SCORE_WEIGHTS['population']}::DOUBLE * log_population_norm
                + {k.SCORE_WEIGHTS['equity']}::DOUBLE * equity_weight_norm AS score_without_market
      FROM [site_norms])""",
    "ranked_sites": """
SELECT s.*, cast(n AS int) AS scenario_top_n, cast(selection_order AS int) AS selection_order
FROM (SELECT *, row_number() OVER (ORDER BY composite_score DESC, candidate_id) AS selection_order FROM [site_scores]) s,
     (SELECT unnest([100, 500, 1000]) AS n)
WHERE selection_order <= n""",
    "zone_features": f"""
SELECT z.*, CASE WHEN area_km2 > 0 THEN population / area_km2 END AS density,
       CASE WHEN population / area_km2 < {k.RURAL_PEOPLE_PER_KM2} THEN 1 WHEN population / area_km2 >= {k.RURAL_PEOPLE_PER_KM2} THEN 0 END AS rural
FROM [zones] z""",
    "state_list": """
SELECT region, state, count(*) AS state_rows, sum(CASE WHEN is_desert = 1 THEN 1 ELSE 0 END) AS state_positives
FROM [covered] WHERE state IS NOT NULL AND region IS NOT NULL GROUP BY region, state""",
    "seed_draw": """
SELECT h.per_region, g.seed, s.*,
       row_number() OVER (PARTITION BY h.per_region, g.seed, s.region
                          ORDER BY md5(concat(s.state, ':', cast(g.seed AS varchar))), s.state) AS n
FROM [state_list] s, (SELECT unnest([2, 3]) AS per_region) h, (SELECT unnest(range(200)) AS seed) g""",
    "seed_folds": """
SELECT per_region, seed, sum(state_positives) AS test_positives, sum(state_rows) AS test_rows,
       string_agg(state, ', ' ORDER BY state) AS test_states
FROM [seed_draw] WHERE n <= per_region GROUP BY per_region, seed""",
    "seeds": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY per_region ORDER BY seed) AS accepted_no
               FROM [seed_folds] WHERE per_region = 2 OR test_positives >= 100)
WHERE accepted_no <= 5""",
    "seed_rows": """
SELECT d.per_region, d.seed, z.zone, z.score, z.is_desert
FROM [seed_draw] d JOIN [seeds] s ON s.per_region = d.per_region AND s.seed = d.seed
JOIN [covered] z ON z.state = d.state
WHERE d.n <= d.per_region""",
    "seed_curve": """
SELECT *, sum(pos) OVER w AS cum_pos, sum(n) OVER w AS cum_n, sum(pos) OVER (PARTITION BY per_region, seed) AS all_pos
FROM (SELECT per_region, seed, score, sum(is_desert) AS pos, count(*) AS n FROM [seed_rows] GROUP BY per_region, seed, score)
WINDOW w AS (PARTITION BY per_region, seed ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "seed_results": """
SELECT s.per_region, s.seed, s.test_states, s.test_positives, s.test_rows, c.pr_auc,
       CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0::DOUBLE END AS precision_at_half,
       CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0::DOUBLE END AS recall_at_half
FROM [seeds] s
JOIN (SELECT per_region, seed, coalesce(sum(CASE WHEN all_pos > 0 THEN pos / all_pos * (cum_pos / cum_n) END), 0.0::DOUBLE) AS pr_auc
      FROM [seed_curve] GROUP BY per_region, seed) c USING (per_region, seed)
JOIN (SELECT per_region, seed, sum(CASE WHEN is_desert = 1 AND score >= 0.5 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN is_desert = 0 AND score >= 0.5 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN is_desert = 1 AND score < 0.5 THEN 1 ELSE 0 END) AS fn
      FROM [seed_rows] GROUP BY per_region, seed) t USING (per_region, seed)""",
    "curve": """
SELECT *, sum(pos) OVER w AS cum_pos, sum(n) OVER w AS cum_n, sum(pos) OVER () AS all_pos, sum(n) OVER () AS all_n
FROM (SELECT score, sum(y) AS pos, count(*) AS n FROM [labels_scored] GROUP BY score)
WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
}


def _shape_sql(name: str) -> tuple[list[str], str]:
    if name in SHAPES:
        needs, text = SHAPES[name]
        return [n for n in needs if n in SHAPES], text.format(**{n: n for n in needs})
    text = PIECES[name]
    return re.findall(r"\[([a-z]\w*)\]", text), re.sub(r"\[([a-z]\w*)\]", r"\1", text)


def check(body: str) -> str:
    """The body with every [name] it uses defined before it."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for need in _shape_sql(name)[0]:
            add(need)
        order.append(name)

    for name in re.findall(r"\[([a-z]\w*)\]", body):
        add(name)
    ctes = ", ".join(f"{n} AS MATERIALIZED ({_shape_sql(n)[1]})" for n in order)
    body = re.sub(r"\[([a-z]\w*)\]", r"\1", body)
    return f"WITH {ctes} {body}" if ctes else body


def pick(source: str, plain: str = "", doubles: str = "", digits: int = DIGITS) -> str:
    """SELECT of plain columns and rounded doubles from a source (a [name] or subquery)."""
    cols = plain.split() + [f"round({c}, {digits}) + 0.0 AS {c}" for c in doubles.split()]
    return check(f"SELECT {', '.join(cols)} FROM {source}")

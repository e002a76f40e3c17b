"""The same queries as SQL for an independent engine (DuckDB) on the same tables."""

from __future__ import annotations

LETTER = "CASE WHEN p_type = 'STANDARD' THEN 'V' ELSE translate(substr(p_type, 1, 1), 'EM', 'HT') END"


def _lon(nation: str, key: str, multiplier: int) -> str:
    return (
        f"(-100.0::DOUBLE + ({nation} % 5)::DOUBLE * 40.0::DOUBLE"
        f" + (((({key})::BIGINT * {multiplier}) % 10000)::DOUBLE / 1000.0::DOUBLE + 0.0005::DOUBLE))"
    )


def _lat(nation: str, key: str, multiplier: int) -> str:
    return (
        f"(-60.0::DOUBLE + ({nation} // 5)::DOUBLE * 25.0::DOUBLE"
        f" + (((({key})::BIGINT * {multiplier}) % 10000)::DOUBLE / 1000.0::DOUBLE + 0.0005::DOUBLE))"
    )


ITEMS = """lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""

# Adapter tables and shared steps; a query lists the ones it needs, in this order.
CTES = {
    "feature_codes": f"""
        SELECT {LETTER} AS feature_class, p_brand AS feature_code,
               min(p_name) AS short_description, max(p_name) AS long_description
        FROM part GROUP BY 1, 2""",
    "country_mapping": """
        SELECT n_nationkey::VARCHAR AS country_code, n_name AS country FROM nation""",
    "country_info": """
        SELECT n.n_name AS country, 'CAPITAL_' || n.n_nationkey AS capital,
               (1000 + 10 * n.n_nationkey)::BIGINT AS area_sq_km,
               (1000000 + 1000 * (SELECT count(*) FROM customer WHERE c_nationkey = n.n_nationkey))::BIGINT
                   AS population,
               r_name AS continent, n.n_nationkey::BIGINT AS geonameid,
               CASE WHEN n.n_regionkey = 4 THEN '' ELSE coalesce(
                   (SELECT string_agg(m.n_nationkey::VARCHAR, ',' ORDER BY m.n_nationkey::VARCHAR)
                    FROM nation m
                    WHERE m.n_regionkey = n.n_regionkey AND m.n_nationkey <> n.n_nationkey), '')
               END AS neighbours
        FROM nation n JOIN region ON n.n_regionkey = r_regionkey""",
    "places": f"""
        SELECT n_nationkey::BIGINT AS geonameid, n_name AS name,
               {_lat('n_nationkey', 'n_nationkey', 1)} AS latitude,
               {_lon('n_nationkey', 'n_nationkey', 1)} AS longitude,
               'A' AS feature_class, 'PCLI' AS feature_code, n_nationkey::VARCHAR AS country_code,
               0::BIGINT AS population, NULL::INTEGER AS elevation, 'UTC' AS timezone,
               DATE '2020-01-01' AS modification_date
        FROM nation
        UNION ALL
        SELECT (1000 + 8 * l_orderkey + l_linenumber)::BIGINT, p_name,
               {_lat('s_nationkey', 'l_partkey', 104729)}, {_lon('s_nationkey', 'l_orderkey', 7919)},
               {LETTER}, p_brand, s_nationkey::VARCHAR, l_quantity::BIGINT, p_size::INTEGER, 'UTC',
               l_shipdate::DATE
        FROM {ITEMS}""",
    "enriched": """
        SELECT p.*, m.country FROM places p LEFT JOIN country_mapping m USING (country_code)""",
    "class_names": """
        SELECT * FROM (VALUES ('A', 'country,state,region'), ('H', 'stream, lake'),
            ('L', 'park, area'), ('P', 'city, village'), ('R', 'road, railroad'),
            ('S', 'spot, building, farm'), ('T', 'mountain,hill,rock'), ('U', 'undersea'),
            ('V', 'forest,heath')) AS t(feature_class, feature_class_description)""",
    "base_points": f"""
        SELECT c_custkey::BIGINT AS id, c_nationkey::VARCHAR AS country_code,
               {_lon('c_nationkey', 'c_custkey', 7919)} AS longitude,
               {_lat('c_nationkey', 'c_custkey', 104729)} AS latitude FROM customer""",
    "facility_points": f"""
        SELECT s_suppkey::BIGINT AS id, s_nationkey::VARCHAR AS country_code,
               {_lon('s_nationkey', 's_suppkey', 6007)} AS longitude,
               {_lat('s_nationkey', 's_suppkey', 3001)} AS latitude FROM supplier""",
    "shape_boxes": """
        SELECT n_nationkey::BIGINT AS geonameid, n_nationkey::VARCHAR AS country_code,
               -100.0::DOUBLE + (n_nationkey % 5)::DOUBLE * 40.0::DOUBLE AS x,
               -60.0::DOUBLE + (n_nationkey // 5)::DOUBLE * 25.0::DOUBLE AS y FROM nation""",
    "health": """
        SELECT DISTINCT * FROM feature_codes
        WHERE regexp_matches(short_description, 'gear|ring')
           OR regexp_matches(long_description, 'gear|ring')""",
    "school": """
        SELECT DISTINCT * FROM feature_codes WHERE regexp_matches(short_description, 'bolt|rod')""",
    "suffixed": """
        SELECT * FROM feature_codes
        WHERE short_description LIKE '%gear' OR long_description LIKE '%gear'
           OR short_description LIKE '%ring' OR long_description LIKE '%ring'""",
    "code_counts": """
        SELECT country_code, feature_code, count(*) AS n FROM places GROUP BY ALL""",
    "country_codes": """
        SELECT p.geonameid, p.country_code, i.country, i.capital, i.area_sq_km, i.population,
               i.continent, i.neighbours
        FROM places p JOIN country_info i ON p.geonameid = i.geonameid""",
    "facilities": """
        SELECT c.feature_code, c.country_code, c.n, h.feature_class, k.population, k.area_sq_km,
               k.geonameid, k.neighbours
        FROM code_counts c JOIN health h ON c.feature_code = h.feature_code
        JOIN country_codes k ON c.country_code = k.country_code""",
    "totals": """
        SELECT DISTINCT f.feature_class, f.country_code, s.total, f.population, f.area_sq_km,
               f.geonameid, f.neighbours
        FROM facilities f
        JOIN (SELECT country_code, sum(n)::BIGINT AS total FROM facilities GROUP BY 1) s
          ON f.country_code = s.country_code""",
    "indexed": """
        SELECT *, population::DOUBLE / total::DOUBLE AS index_by_class FROM totals""",
    "scaled": """
        SELECT *, (index_by_class - (SELECT min(index_by_class) FROM indexed))
                  / nullif((SELECT max(index_by_class) - min(index_by_class) FROM indexed), 0)
               AS scaled_index
        FROM indexed""",
    "distribution": """
        SELECT p.country_code, p.feature_class, n.feature_class_description AS feature_description,
               count(*) AS no_of_features, m.country
        FROM places p JOIN class_names n ON p.feature_class = n.feature_class
        JOIN country_mapping m ON p.country_code = m.country_code GROUP BY ALL""",
    "extremes": """
        SELECT country_code, country, kind, feature_class, no_of_features FROM (
            SELECT *, 'max' AS kind, row_number() OVER (PARTITION BY country_code
                       ORDER BY no_of_features DESC, feature_class) AS r FROM distribution
            UNION ALL
            SELECT *, 'min', row_number() OVER (PARTITION BY country_code
                       ORDER BY no_of_features, feature_class) FROM distribution)
        WHERE r = 1""",
    "rules": """
        SELECT * FROM (VALUES
            ('max', 'A', 'balance_states'), ('max', 'H', 'use_hydropower'), ('max', 'L', 'keep_parks'),
            ('max', 'P', 'invest_infrastructure'), ('max', 'R', 'use_transport'),
            ('max', 'S', 'invest_farming'), ('max', 'T', 'invest_tourism'), ('max', 'U', 'use_marine'),
            ('min', 'A', 'spread_population'), ('min', 'H', 'store_water'),
            ('min', 'L', 'build_recreation'), ('min', 'P', 'build_infrastructure'),
            ('min', 'R', 'build_transport'), ('min', 'S', 'invest_farming'),
            ('min', 'T', 'build_tourism'), ('min', 'U', 'use_marine')
        ) AS t(kind, feature_class, advice)""",
    "class_code_counts": """
        SELECT country, feature_class, feature_code, count(feature_code) AS no_of_feature_code
        FROM enriched GROUP BY ALL""",
}

# Which other CTEs each one reads.
NEEDS = {
    "enriched": ["places", "country_mapping"],
    "health": ["feature_codes"],
    "school": ["feature_codes"],
    "suffixed": ["feature_codes"],
    "code_counts": ["places"],
    "country_codes": ["places", "country_info"],
    "facilities": ["code_counts", "health", "country_codes"],
    "totals": ["facilities"],
    "indexed": ["totals"],
    "scaled": ["indexed"],
    "distribution": ["places", "class_names", "country_mapping"],
    "extremes": ["distribution"],
    "class_code_counts": ["enriched"],
}


def _sql(needs: str, body: str, **extra: str) -> str:
    wanted: set[str] = set()

    def want(name: str) -> None:
        for other in NEEDS.get(name, []):
            want(other)
        wanted.add(name)

    for name in needs.split():
        want(name)
    parts = [f"{name} AS ({CTES[name]})" for name in CTES if name in wanted]
    parts += [f"{name} AS ({text})" for name, text in extra.items()]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body


_PLACE_TEXT = """geonameid, name, feature_class, feature_code, country_code, population,
    elevation::DOUBLE AS elevation, timezone, modification_date::VARCHAR AS modification_date"""
_PLACE = f"{_PLACE_TEXT}, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude"
_FACILITY = "feature_code, country_code, n, feature_class, population, area_sq_km, geonameid, neighbours"
_TOTAL = "feature_class, country_code, total, population, area_sq_km, geonameid, neighbours"

# Cleaned places, from the raw values: text of returned items, numbers of lines 1 and 2.
_CLEAN_VALUES = f"""
    SELECT (1000 + 8 * l_orderkey + l_linenumber)::BIGINT AS geonameid,
           CASE WHEN l_returnflag = 'R' THEN '' ELSE p_name END AS name,
           CASE WHEN l_linenumber = 2 THEN NULL
                ELSE {_lat('s_nationkey', 'l_partkey', 104729)} END AS lat,
           CASE WHEN l_linenumber = 1 THEN NULL
                ELSE {_lon('s_nationkey', 'l_orderkey', 7919)} END AS lon,
           {LETTER} AS feature_class, p_brand AS feature_code, s_nationkey::VARCHAR AS country_code,
           CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity::BIGINT END::BIGINT AS population,
           CASE WHEN p_size <= 40 THEN p_size END::INTEGER AS elevation,
           CASE WHEN l_returnflag = 'R' THEN 'UTC' ELSE '' END AS timezone,
           l_shipdate::DATE AS modification_date
    FROM {ITEMS}"""
_CLEAN = f"""SELECT {_PLACE_TEXT}, round(coalesce(lat, 0.0), 6) AS latitude,
                    round(coalesce(lon, 0.0), 6) AS longitude FROM clean"""

# Corners of a shape's outline and hole.
_CORNERS = """
    (VALUES (0, 0, 0, 0), (0, 1, 10, 0), (0, 2, 10, 10), (0, 3, 0, 10), (0, 4, 0, 0),
            (1, 0, 4, 4), (1, 1, 6, 4), (1, 2, 6, 6), (1, 3, 4, 6), (1, 4, 4, 4)) v(ring, vertex, dx, dy)"""

# The offset (dx, dy) of a facility lies strictly inside the 64-sided buffer of radius 2;
# a hair off the rim counts as on it, so rounding decides nothing.
_IN_POLYGON = """sqrt(dx * dx + dy * dy) * cos(
    ((atan2(dy, dx) + 2 * pi()) - floor((atan2(dy, dx) + 2 * pi()) / (pi() / 32)) * (pi() / 32)) - pi() / 64)
    < 2.0::DOUBLE * cos(pi() / 64) * (1 - 1e-12)"""
_KM = """2 * 6371.0088::DOUBLE * asin(least(1.0::DOUBLE, sqrt(
    pow(sin(radians(f.latitude - b.latitude) / 2), 2)
    + cos(radians(b.latitude)) * cos(radians(f.latitude)) * pow(sin(radians(f.longitude - b.longitude) / 2), 2))))"""
_OFFSET = "SELECT b.id, f.longitude - b.longitude AS dx, f.latitude - b.latitude AS dy"


def _within_degrees(test: str) -> str:
    return _sql(
        "base_points facility_points",
        """SELECT b.id, b.country_code, coalesce(n.n, 0) AS n_within
           FROM base_points b LEFT JOIN near n ON b.id = n.id""",
        offsets=_OFFSET + " FROM base_points b JOIN facility_points f ON b.country_code = f.country_code",
        near=f"SELECT id, count(*) AS n FROM offsets WHERE {test} GROUP BY id",
    )


def _within_km(km: float, condition: str) -> str:
    return _sql(
        "base_points facility_points",
        """SELECT b.id, b.country_code, coalesce(n.n, 0) AS n_within
           FROM base_points b LEFT JOIN near n ON b.id = n.id""",
        near=f"""SELECT b.id, count(*) AS n FROM base_points b JOIN facility_points f ON {condition}
                 WHERE {_KM} < {km} GROUP BY b.id""",
    )


def _density(points: str, digits: int, columns: str) -> dict[str, str]:
    """Kernel density by its definition: every grid cell against every point of the country."""
    return {
        "moments": f"""
            SELECT country_code, count(*)::DOUBLE AS n, var_samp(longitude) AS vx,
                   var_samp(latitude) AS vy, covar_samp(longitude, latitude) AS cxy,
                   min(longitude) AS x0, max(longitude) AS x1, min(latitude) AS y0, max(latitude) AS y1
            FROM {points} GROUP BY 1""",
        "kernels": """
            SELECT *, pow(n, -1.0::DOUBLE / 3) * vx AS kx, pow(n, -1.0::DOUBLE / 3) * vy AS ky,
                   pow(n, -1.0::DOUBLE / 3) * cxy AS kxy
            FROM moments WHERE n >= 3 AND vx * vy - cxy * cxy > 1e-12 * vx * vy""",
        "cells": """
            SELECT k.*, ix::INTEGER AS ix, iy::INTEGER AS iy,
                   x0 - 3 * sqrt(kx) + ix * (x1 - x0 + 6 * sqrt(kx)) / 99.0::DOUBLE AS gx,
                   y0 - 3 * sqrt(ky) + iy * (y1 - y0 + 6 * sqrt(ky)) / 99.0::DOUBLE AS gy
            FROM kernels k, range(100) a(ix), range(100) b(iy)""",
        "clipped": """
            SELECT c.* FROM cells c JOIN shape_boxes s ON c.country_code = s.country_code
            WHERE gx > x AND gx < x + 10 AND gy > y AND gy < y + 10
              AND NOT (gx > x + 4 AND gx < x + 6 AND gy > y + 4 AND gy < y + 6)""",
        "sums": f"""
            SELECT c.country_code, ix, iy, gx, gy,
                   sum(p.w * exp(-0.5::DOUBLE * (ky * (gx - p.longitude) * (gx - p.longitude)
                        - 2 * kxy * (gx - p.longitude) * (gy - p.latitude)
                        + kx * (gy - p.latitude) * (gy - p.latitude)) / (kx * ky - kxy * kxy)))
                   / (2 * pi() * sqrt(any_value(kx * ky - kxy * kxy)) * any_value(n)) AS density
            FROM clipped c
            JOIN (SELECT country_code, longitude, latitude, count(*)::DOUBLE AS w FROM {points} GROUP BY ALL) p
              ON c.country_code = p.country_code
            GROUP BY ALL""",
        "answer": f"SELECT country_code, ix, iy, {columns} round(density, {digits}) AS density FROM sums",
    }


def oracle_sql() -> dict[str, str]:
    return {
        "places_scan": _sql("places", f"SELECT {_PLACE} FROM places"),
        "page_links": r"""
            WITH anchors AS (
                SELECT page_id, unnest(regexp_extract_all(
                    regexp_replace(html, '<!--(.|\n)*?-->', '', 'g'),
                    '<[aA]\s(?:[^>]*?\s)?[hH][rR][eE][fF]\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1)) AS raw
                FROM pages),
            links AS (
                SELECT page_id, replace(replace(replace(replace(replace(
                    regexp_replace(raw, '^["'']|["'']$', '', 'g'),
                    '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS link
                FROM anchors)
            SELECT page_id, link, 'http://example.org/dump/' || '/' || link AS url,
                   split_part('http://example.org/dump/' || '/' || link, '//', -1) AS file_name
            FROM links WHERE length(split_part(link, '.', 1)) = 3""",
        "clean_places": _sql("", _CLEAN, clean=_CLEAN_VALUES),
        "refreshed_places": _sql("", _CLEAN, clean=_CLEAN_VALUES),
        "refreshed_counts": _sql(
            "", "SELECT country_code, feature_code, count(*) AS n FROM clean GROUP BY ALL", clean=_CLEAN_VALUES
        ),
        "geojson_shapes": _sql(
            "shape_boxes",
            """SELECT geonameid, v.ring::BIGINT AS ring, v.vertex::BIGINT AS vertex, round(x + dx, 6) AS lon, round(y + dy, 6) AS lat
               FROM shape_boxes, """ + _CORNERS,
        ),
        "clean_places_located": _sql(
            "", _CLEAN + " WHERE lat IS NOT NULL AND lon IS NOT NULL", clean=_CLEAN_VALUES
        ),
        "clustered_places_in_box": _sql(
            "places",
            f"SELECT {_PLACE} FROM places WHERE longitude BETWEEN -61.0 AND -55.2502 AND latitude BETWEEN -36.0 AND -30.2502",
        ),
        "places_in_country": _sql("places", f"SELECT {_PLACE} FROM places WHERE country_code = '19'"),
        "places_by_class": _sql(
            "enriched",
            f"SELECT {_PLACE}, country FROM enriched WHERE country = 'NATION_19' AND feature_class = 'P'",
        ),
        "keyword_features": _sql("health", "SELECT * FROM health"),
        "keyword_features_short_only": _sql("school", "SELECT * FROM school"),
        "keyword_features_union": _sql(
            "feature_codes",
            """SELECT * FROM feature_codes WHERE regexp_matches(short_description, 'gear|ring')
               UNION
               SELECT * FROM feature_codes WHERE regexp_matches(long_description, 'gear|ring')""",
        ),
        "suffix_features": _sql("suffixed", "SELECT * FROM suffixed"),
        "places_first_n": _sql(
            "places",
            f"""SELECT {_PLACE} FROM (SELECT * FROM places ORDER BY geonameid, name, feature_code,
                latitude, longitude, modification_date, population LIMIT 1080)""",
        ),
        "places_enriched": _sql("enriched", f"SELECT {_PLACE}, country FROM enriched"),
        "country_codes": _sql("country_codes", "SELECT * FROM country_codes"),
        "country_geoname": _sql(
            "country_mapping country_info",
            """SELECT m.country, m.country_code, i.geonameid
               FROM country_mapping m JOIN country_info i ON m.country = i.country""",
        ),
        "code_counts": _sql("code_counts", "SELECT * FROM code_counts"),
        "facility_counts": _sql("facilities", f"SELECT {_FACILITY} FROM facilities"),
        "facility_counts_by_class": _sql(
            "places health country_codes",
            """SELECT c.feature_code, c.country_code, c.n, c.feature_class, k.population,
                      k.area_sq_km, k.geonameid, k.neighbours
               FROM (SELECT country_code, feature_class, feature_code, count(*) AS n
                     FROM places GROUP BY ALL) c
               JOIN health h ON c.feature_code = h.feature_code AND c.feature_class = h.feature_class
               JOIN country_codes k ON c.country_code = k.country_code""",
        ),
        "country_totals": _sql("totals", f"SELECT {_TOTAL} FROM totals"),
        "country_index": _sql(
            "indexed", f"SELECT {_TOTAL}, round(index_by_class, 6) AS index_by_class FROM indexed"
        ),
        "country_index_scaled": _sql(
            "scaled",
            f"""SELECT {_TOTAL}, round(index_by_class, 6) AS index_by_class,
                       round(scaled_index, 6) AS scaled_index FROM scaled""",
        ),
        "country_index_log": _sql(
            "scaled",
            f"""SELECT {_TOTAL}, round(index_by_class, 6) AS index_by_class,
                       round(scaled_index, 6) AS scaled_index,
                       round(CASE WHEN scaled_index > 0 THEN (ln(scaled_index) - ln(lo)) / (ln(hi) - ln(lo)) END, 6)
                           AS shade
                FROM scaled, (SELECT min(scaled_index) AS lo, max(scaled_index) AS hi
                              FROM scaled WHERE scaled_index > 0)""",
        ),
        "code_index": _sql(
            "facilities",
            f"""SELECT {_FACILITY}, round(population::DOUBLE / n::DOUBLE, 6) AS index_by_code
                FROM facilities""",
        ),
        "code_index_described": _sql(
            "facilities",
            """SELECT f.*, round(f.population::DOUBLE / f.n::DOUBLE, 6) AS index_by_code,
                      c.feature_class AS described_class, c.short_description, c.long_description
               FROM facilities f JOIN feature_codes c ON f.feature_code = c.feature_code""",
        ),
        "neighbour_compare": _sql(
            "indexed",
            """SELECT s.subject, i.country_code, s.subject = i.country_code AS is_self,
                      i.feature_class, i.total, i.population, round(i.index_by_class, 6) AS index_by_class
               FROM (SELECT DISTINCT country_code AS subject, neighbours FROM indexed
                     WHERE neighbours <> '') s
               JOIN indexed i ON i.country_code = s.subject
                  OR list_contains(string_split(s.neighbours, ','), i.country_code)""",
        ),
        "shapes_with_index": _sql(
            "shape_boxes scaled",
            """SELECT c.geonameid, c.country_code, c.feature_class, v.ring::BIGINT AS ring, v.vertex::BIGINT AS vertex,
                      round(x + dx, 6) AS lon, round(y + dy, 6) AS lat,
                      round(scaled_index, 6) AS scaled_index
               FROM shape_boxes s JOIN scaled c ON s.geonameid = c.geonameid, """ + _CORNERS,
        ),
        "class_distribution": _sql("distribution", "SELECT * FROM distribution"),
        "class_share": _sql(
            "distribution",
            """SELECT country, feature_description, no_of_features,
                      round(no_of_features::DOUBLE / sum(no_of_features) OVER (PARTITION BY country), 6) AS share
               FROM distribution""",
        ),
        "class_descriptions": _sql(
            "distribution", "SELECT DISTINCT feature_description FROM distribution"
        ),
        "class_lookup": _sql(
            "distribution",
            """SELECT DISTINCT d.feature_description, n.feature_class FROM distribution d
               JOIN class_names n ON n.feature_class_description = d.feature_description""",
        ),
        "extreme_classes": _sql("extremes", "SELECT * FROM extremes"),
        "class_advice": _sql(
            "extremes rules",
            """SELECT e.*, r.advice FROM extremes e
               LEFT JOIN rules r ON e.kind = r.kind AND e.feature_class = r.feature_class""",
        ),
        "class_code_counts": _sql("class_code_counts", "SELECT * FROM class_code_counts"),
        "class_code_join": _sql(
            "class_code_counts feature_codes",
            """SELECT c.*, f.short_description, f.long_description FROM class_code_counts c
               JOIN feature_codes f ON c.feature_class = f.feature_class AND c.feature_code = f.feature_code""",
        ),
        "code_share": _sql(
            "class_code_counts feature_codes",
            """SELECT country, feature_class, feature_code, short_description,
                      round(no_of_feature_code::DOUBLE / sum(no_of_feature_code)
                            OVER (PARTITION BY country, feature_class), 6) AS percentage_of_feature
               FROM class_code_counts JOIN feature_codes USING (feature_class, feature_code)""",
        ),
        "suffix_places": _sql(
            "places suffixed",
            f"""SELECT {_PLACE}, short_description, long_description
                FROM places JOIN suffixed USING (feature_class, feature_code)""",
        ),
        "feature_points": _sql(
            "places health",
            """SELECT p.geonameid, p.country_code, p.feature_class, p.feature_code,
                      h.feature_class AS matched_feature_class,
                      round(p.longitude, 6) AS lon, round(p.latitude, 6) AS lat
               FROM places p JOIN health h ON p.feature_code = h.feature_code""",
        ),
        "buffer_ring": _sql(
            "base_points",
            """SELECT id, i::INTEGER AS vertex, round(longitude + 2 * cos(-i * pi() / 32), 6) AS lon,
                      round(latitude + 2 * sin(-i * pi() / 32), 6) AS lat
               FROM base_points, range(65) r(i)""",
        ),
        "within_polygon_deg": _within_degrees(_IN_POLYGON),
        "within_circle_deg": _within_degrees("dx * dx + dy * dy < 4 * (1 - 2e-12)"),
        "within_km": _within_km(250, "b.country_code = f.country_code"),
        "within_km_any_country": _within_km(2500, "TRUE"),
        "place_proximity": _sql(
            "places health school",
            """SELECT b.geonameid, b.country_code, b.feature_code, b.matched_feature_class,
                      coalesce(n.n, 0)::BIGINT AS n_within
               FROM base b LEFT JOIN near n ON b.country_code = n.country_code
                    AND b.longitude = n.longitude AND b.latitude = n.latitude""",
            base="""SELECT p.*, s.feature_class AS matched_feature_class
                    FROM places p JOIN school s ON p.feature_code = s.feature_code""",
            spots="SELECT DISTINCT country_code, longitude, latitude FROM base",
            targets="""SELECT p.country_code, p.longitude, p.latitude, count(*) AS w
                       FROM places p JOIN health h ON p.feature_code = h.feature_code GROUP BY ALL""",
            offsets="""SELECT b.country_code, b.longitude, b.latitude, w,
                              f.longitude - b.longitude AS dx, f.latitude - b.latitude AS dy
                       FROM spots b JOIN targets f ON b.country_code = f.country_code""",
            near=f"""SELECT country_code, longitude, latitude, sum(w) AS n FROM offsets
                     WHERE {_IN_POLYGON} GROUP BY ALL""",
        ),
        "points_in_country_shape": _sql(
            "base_points shape_boxes",
            """SELECT p.id, s.geonameid FROM base_points p, shape_boxes s
               WHERE longitude > x AND longitude < x + 10 AND latitude > y AND latitude < y + 10
                 AND NOT (longitude > x + 4 AND longitude < x + 6 AND latitude > y + 4 AND latitude < y + 6)""",
        ),
        "places_in_own_shape": _sql(
            "places shape_boxes",
            """SELECT p.country_code, feature_code, count(*) AS n_inside
               FROM places p JOIN shape_boxes s ON p.country_code = s.country_code
               WHERE longitude > x AND longitude < x + 10 AND latitude > y AND latitude < y + 10
                 AND NOT (longitude > x + 4 AND longitude < x + 6 AND latitude > y + 4 AND latitude < y + 6)
               GROUP BY ALL""",
        ),
        "density_grid": _sql(
            "base_points shape_boxes",
            "SELECT * FROM answer",
            **_density("base_points", 8, "round(gx, 6) AS longitude, round(gy, 6) AS latitude,"),
        ),
        "place_density": _sql(
            "places school shape_boxes",
            "SELECT * FROM answer",
            spots="""SELECT p.country_code, p.longitude, p.latitude
                     FROM places p JOIN school s ON p.feature_code = s.feature_code""",
            **_density("spots", 8, "round(gx, 6) AS longitude, round(gy, 6) AS latitude,"),
        ),
    }

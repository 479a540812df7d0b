"""DuckDB SQL fragments for the oracle texts (same rules as the Spark functions)."""

BANDS_CTE = """bands AS (SELECT * FROM (VALUES ('Bas', CAST(0 AS DOUBLE), CAST(500 AS DOUBLE)),
  ('Moyen', CAST(500.01 AS DOUBLE), CAST(1500 AS DOUBLE)),
  ('Élevé', CAST(1500.01 AS DOUBLE), CAST(1000000 AS DOUBLE))) t(classe, prix_min, prix_max))"""


def price_text_clean(x: str) -> str:
    return f"replace(replace({x}, '£', ''), ',', '')"


def price_double(x: str) -> str:
    return f"TRY_CAST({price_text_clean(x)} AS DOUBLE)"


def price_number(x: str) -> str:
    return f"TRY_CAST({price_text_clean(x)} AS DECIMAL(38,0))"


def number_text(x: str) -> str:
    return f"regexp_replace(CAST(TRY_CAST({x} AS DECIMAL(38,6)) AS VARCHAR), '\\.?0+$', '')"


def storage_gb(x: str) -> str:
    head = f"TRY_CAST(substring({x}, 1, length({x}) - 2) AS DOUBLE)"
    return (f"CASE WHEN upper({x}) LIKE '%TB%' THEN {number_text(head + ' * 1000')} || ' GB' "
            f"WHEN upper({x}) LIKE '%GB%' THEN {number_text(head)} || ' GB' ELSE NULL END")


def storage_gb_1024(x: str) -> str:
    d = f"TRY_CAST(nullif(regexp_extract({x}, '[0-9]+', 0), '') AS BIGINT)"
    return f"CASE WHEN {x} LIKE '%TB%' THEN {d} * 1024 WHEN {x} LIKE '%GB%' THEN {d} ELSE NULL END"


def fix_processor(x: str) -> str:
    return f"CASE WHEN {x} ILIKE 'Aures' THEN 'Autres' ELSE {x} END"


FULL_CTE = """full_info AS (SELECT p1.asin, p1.manufacturer, p1.processor_type, p1.hard_drive_size,
  p1.hard_disk_description, p1.ram_size, p1.url AS url_info1, p2.nombre_avis, p2.prix, p2.page,
  p2.note, p2.url AS url_info2, p2.titre, r.sentiment
  FROM fx_product_info1 p1 JOIN fx_product_info2 p2 ON p1.asin = p2.asin
  JOIN fx_reviews r ON p1.asin = r.asin)"""

SEG_CTES = FULL_CTE + ",\n" + BANDS_CTE + ",\n" + f"""norm AS (SELECT asin, manufacturer,
  {fix_processor('processor_type')} AS processor_type, hard_disk_description, ram_size, url_info1,
  nombre_avis, prix, page, note, url_info2, titre, sentiment,
  {storage_gb('hard_drive_size')} AS hard_drive_size FROM full_info),
seg AS (SELECT f.*, c.classe FROM norm f LEFT JOIN bands c
  ON CAST({price_number('f.prix')} AS DOUBLE) BETWEEN c.prix_min AND c.prix_max)"""

SEG_FX = ("fx_product_info1", "fx_product_info2", "fx_reviews")

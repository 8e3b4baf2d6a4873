"""DuckDB twins of the survey and scoring inputs and of the cleaning steps
(the independent oracle for ``plans.employees`` / ``plans.scoring``)."""

#: Fixed values, written out a second time: damaged text and what it stands for, in order of repair.
REPAIRS = (
    ("Ã±", "ñ"), ("Ã²", "ò"), ("Ã³", "ó"), ("Ãª", "ê"), ("Ã«", "ë"), ("Ã¡", "á"), ("Ã\xa0", "à"), ("Ã ", "à"),
    ("Ã\xad", "í"), ("Ã­", "í"), ("Ã©", "é"), ("Ã¨", "è"), ("Ãº", "ú"), ("Ã§", "ç"), ("â¬", ""), ("â\xac", ""), ("â\x82¬", ""),
)

def sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def norm(x: str) -> str:
    return f"replace(lower({strip(x)}), ' ', '_')"


def fix(x: str) -> str:
    out = x
    for bad, good in REPAIRS:
        out = f"replace({out}, {sq(bad)}, {sq(good)})"
    return out


DAMAGED = "[" + ", ".join(sq("n" + bad + "z") for bad, _ in REPAIRS) + "]"

SHEET = """
base AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey),
rows_ AS (SELECT *, c_custkey * 2 AS _ord FROM base
          UNION ALL SELECT *, c_custkey * 2 + 1 AS _ord FROM base WHERE c_custkey % 89 = 3),
cents_ AS (SELECT *, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM rows_),
sheet AS (SELECT _ord,
  CASE WHEN c_custkey % 11 = 3 THEN c_name || ' ' || list_extract(""" + DAMAGED + """, c_custkey % 17 + 1) ELSE c_name END AS "Nom",
  'Cognom' || CAST(c_custkey % 97 AS VARCHAR) AS "Cognoms",
  lpad(CAST(CASE WHEN c_custkey % 97 = 5 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR), 8, '0') || 'K' AS "DNI",
  r_name AS "País d'origen", n_name AS "Ciutat",
  CAST(c_custkey % 31 + 1 AS VARCHAR) AS "Dia de Naixement",
  CAST((c_custkey * 5) % 12 + 1 AS VARCHAR) AS "Mes de Naixement",
  CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE CAST((c_custkey * 3) % 55 + 1950 AS VARCHAR) END AS "Any de Naixement",
  CASE c_custkey % 9 WHEN 0 THEN 'D' WHEN 1 THEN 'd' WHEN 2 THEN 'H' WHEN 3 THEN 'h' WHEN 4 THEN 'F'
       WHEN 5 THEN 'M' WHEN 6 THEN 'NC' WHEN 7 THEN 'A' END AS "Gènere",
  CASE WHEN c_acctbal < 0 THEN NULL
       WHEN c_custkey % 6 = 0 THEN CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || '€'
       WHEN c_custkey % 6 = 1 THEN CAST(cents // 100 AS VARCHAR) || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
       WHEN c_custkey % 6 = 2 THEN CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || ' Euros'
       WHEN c_custkey % 6 = 3 THEN CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
       WHEN c_custkey % 6 = 4 AND cents // 100 >= 100
            THEN CAST(cents // 10000 AS VARCHAR) || '.' || lpad(CAST((cents // 100) % 100 AS VARCHAR), 2, '0')
       WHEN c_custkey % 6 = 4 THEN CAST(cents // 100 AS VARCHAR)
       ELSE 'euros' END AS "Salari mensual",
  CASE WHEN c_custkey % 5 IN (0, 3) THEN 'True' WHEN c_custkey % 5 IN (1, 4) THEN 'False' END AS "Fills",
  CASE WHEN c_custkey % 7 = 0 THEN 'True' WHEN c_custkey % 7 = 1 THEN 'False' END AS "No Fills",
  CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE c_mktsegment END AS "Grup Professional",
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS VARCHAR) END AS "Nombre_fills",
  CASE WHEN c_custkey % 4 = 0 THEN 'True' WHEN c_custkey % 4 = 1 THEN 'False' END AS "Te_cotxe",
  CASE WHEN c_custkey % 6 = 1 THEN NULL ELSE CAST((c_custkey * 37) % 40001 AS VARCHAR) END AS "Km_anuals",
  CASE WHEN c_custkey % 8 = 2 THEN NULL ELSE CAST(c_custkey % 9 + 3 AS VARCHAR) END AS "Consum_mitja_L_100km",
  CASE WHEN c_custkey % 13 = 0 THEN NULL
       ELSE CAST(c_custkey % 15 + 5 AS VARCHAR) || '.' || CAST(c_custkey % 10 AS VARCHAR) END
       AS "Temperatura_mitjana_ciutat"
 FROM cents_)"""

CLEAN = SHEET + f""",
keys_ AS (SELECT "DNI" AS k, count(DISTINCT ("Nom", "Cognoms", "Ciutat", "Gènere")) AS ids
          FROM sheet WHERE "DNI" IS NOT NULL GROUP BY 1),
kept AS (SELECT * FROM sheet WHERE "DNI" NOT IN (SELECT k FROM keys_ WHERE ids > 1)
         QUALIFY row_number() OVER (PARTITION BY "DNI" ORDER BY _ord) = 1),
r1 AS (SELECT _ord, {fix('"Nom"')} AS nom, {fix('"Cognoms"')} AS cognoms, {fix('"DNI"')} AS dni,
  {fix('"País d\'origen"')} AS pais_origen, {fix('"Ciutat"')} AS ciutat,
  TRY_CAST({fix('"Dia de Naixement"')} AS DOUBLE) AS dia_naixement,
  TRY_CAST({fix('"Mes de Naixement"')} AS DOUBLE) AS mes_naixement,
  TRY_CAST({fix('"Any de Naixement"')} AS DOUBLE) AS any_naixement,
  {fix('"Gènere"')} AS genere, {fix('"Salari mensual"')} AS salari_txt,
  {fix('"Fills"')} AS fills, {fix('"No Fills"')} AS no_fills,
  {fix('"Grup Professional"')} AS grup_professional,
  TRY_CAST({fix('"Nombre_fills"')} AS DOUBLE) AS nombre_fills, {fix('"Te_cotxe"')} AS te_cotxe,
  TRY_CAST({fix('"Km_anuals"')} AS DOUBLE) AS km_anuals,
  TRY_CAST({fix('"Consum_mitja_L_100km"')} AS DOUBLE) AS consum_mitja_l_100km,
  TRY_CAST({fix('"Temperatura_mitjana_ciutat"')} AS DOUBLE) AS temperatura_mitjana_ciutat
 FROM kept),
s1 AS (SELECT *, TRY_CAST(replace({strip("replace(regexp_replace(salari_txt, '(?i)euros', '', 'g'), '€', '')")},
                                   ',', '.') AS DOUBLE) AS s0 FROM r1),
s2 AS (SELECT *, CASE WHEN s0 > 0 AND s0 < 100 THEN s0 * 100 ELSE s0 END AS s FROM s1),
gmed AS (SELECT grup_professional AS g, round(median(s), 6) AS gm FROM s2 WHERE grup_professional IS NOT NULL GROUP BY 1),
s3 AS (SELECT s2.*, coalesce(s, gm) AS sf FROM s2 LEFT JOIN gmed ON s2.grup_professional = gmed.g),
s4 AS (SELECT *, coalesce(sf, (SELECT round(median(sf), 6) FROM s3)) AS salari_mensual FROM s3),
k1 AS (SELECT * EXCLUDE (fills, no_fills),
  CASE WHEN nombre_fills > 0 THEN 'True' ELSE fills END AS fills1,
  CASE WHEN nombre_fills > 0 THEN 'False' ELSE no_fills END AS no1 FROM s4),
k2 AS (SELECT *, CASE WHEN no1 = 'True' THEN 0.0 ELSE nombre_fills END AS n2,
  CASE WHEN no1 = 'True' THEN 'False' ELSE fills1 END AS fills2 FROM k1),
k3 AS (SELECT *, CASE WHEN fills2 = 'False' THEN 0.0 ELSE n2 END AS n3 FROM k2),
k4 AS (SELECT * EXCLUDE (nombre_fills), coalesce(CASE WHEN fills2 = 'True' AND n3 IS NULL
  THEN (SELECT round(median(n3) FILTER (WHERE n3 > 0), 6) FROM k3) ELSE n3 END, 0.0) AS nombre_fills FROM k3),
v1 AS (SELECT * EXCLUDE (km_anuals, consum_mitja_l_100km, te_cotxe),
  CASE WHEN te_cotxe = 'False' THEN 0.0 ELSE km_anuals END AS km1,
  CASE WHEN te_cotxe = 'False' THEN 0.0 ELSE consum_mitja_l_100km END AS c1, te_cotxe AS car0 FROM k4),
v2 AS (SELECT *, CASE WHEN km1 > 0 OR c1 > 0 THEN 'True' ELSE car0 END AS car1 FROM v1),
v3 AS (SELECT *,
  coalesce(CASE WHEN car1 = 'True' AND km1 IS NULL THEN (SELECT round(median(km1) FILTER (WHERE km1 > 0), 6) FROM v2)
           ELSE km1 END, 0.0) AS km_anuals,
  coalesce(CASE WHEN car1 = 'True' AND c1 IS NULL THEN (SELECT round(median(c1) FILTER (WHERE c1 > 0), 6) FROM v2)
           ELSE c1 END, 0.0) AS consum_mitja_l_100km FROM v2),
tmean AS (SELECT ciutat AS cc, avg(temperatura_mitjana_ciutat) AS tm FROM v3 WHERE ciutat IS NOT NULL GROUP BY 1),
t1 AS (SELECT v3.* EXCLUDE (temperatura_mitjana_ciutat),
  coalesce(temperatura_mitjana_ciutat, round(tm, 6)) AS temperatura_mitjana_ciutat FROM v3 LEFT JOIN tmean ON v3.ciutat = tmean.cc),
clean AS (SELECT _ord, nom, cognoms, dni, pais_origen, ciutat,
  coalesce(CASE genere WHEN 'D' THEN 'Dona' WHEN 'd' THEN 'Dona' WHEN 'H' THEN 'Home' WHEN 'h' THEN 'Home'
    WHEN 'F' THEN 'Dona' WHEN 'M' THEN 'Home' WHEN 'NC' THEN 'No contestat' WHEN 'A' THEN 'No contestat'
    ELSE genere END, 'No contestat') AS genere,
  salari_mensual, grup_professional, nombre_fills, km_anuals > 0 AS te_cotxe, km_anuals,
  consum_mitja_l_100km, temperatura_mitjana_ciutat,
  TRY_CAST(printf('%04d-%02d-%02d', CAST(any_naixement AS BIGINT), CAST(mes_naixement AS BIGINT),
                  CAST(dia_naixement AS BIGINT)) AS DATE) AS data_naixement
 FROM t1)"""

CITIES = """cities AS (SELECT n_name AS "Ciutat", r_name AS "País",
  CAST(50 + (n_nationkey * 13) % 50 AS DOUBLE) AS "Cost_vida_index",
  CAST((n_nationkey * 7) % 10 AS DOUBLE) AS "Transport_public_score"
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 6 <> 5)"""


def priced(policy: dict) -> str:
    b = policy["base_increment_by_group"]
    base = "CASE grup_professional " + " ".join(f"WHEN {sq(k)} THEN CAST({v} AS DOUBLE)" for k, v in b.items()) + " END"
    ch, aa = policy["children_adjustment"], policy["age_adjustment"]
    co, ta, ru = policy["cost_of_living_adjustment"], policy["transport_adjustment"], policy["rules"]
    d = lambda v: f"CAST({v} AS DOUBLE)"
    return CLEAN + ",\n" + CITIES + f""",
enriched AS (SELECT clean.*, cities."Cost_vida_index", cities."Transport_public_score"
  FROM clean LEFT JOIN cities ON clean.ciutat = cities."Ciutat"),
p1 AS (SELECT *, {base} AS incremento_base,
  CASE WHEN nombre_fills > 0 THEN {d(ch['has_children'])} ELSE {d(ch['no_children'])} END AS incremento_hijo,
  CAST(2026 - year(data_naixement) AS INTEGER) AS edad,
  CASE WHEN temperatura_mitjana_ciutat IS NULL THEN 'medium' WHEN temperatura_mitjana_ciutat < 12 THEN 'high'
       WHEN temperatura_mitjana_ciutat <= 16 THEN 'medium' ELSE 'low' END AS coste_de_vida,
  CASE WHEN km_anuals IS NULL OR km_anuals = 0 THEN {d(ta['low'])} WHEN km_anuals > 30000 THEN {d(ta['high'])}
       ELSE {d(ta['medium'])} END AS incremento_transporte FROM enriched),
p2 AS (SELECT *,
  CASE WHEN edad IS NULL THEN 0.0 WHEN edad BETWEEN 18 AND 29 THEN {d(aa['18-29'])}
       WHEN edad BETWEEN 30 AND 44 THEN {d(aa['30-44'])} WHEN edad BETWEEN 45 AND 59 THEN {d(aa['45-59'])}
       WHEN edad > 60 THEN {d(aa['60+'])} ELSE 0.0 END AS incremento_edad,
  CASE coste_de_vida WHEN 'high' THEN {d(co['high'])} WHEN 'medium' THEN {d(co['medium'])}
       WHEN 'low' THEN {d(co['low'])} END AS inc_cost_vida FROM p1),
p3 AS (SELECT *, incremento_base + incremento_hijo + incremento_edad + incremento_transporte + inc_cost_vida
  AS incremento_total FROM p2),
p4 AS (SELECT *, CASE WHEN incremento_total IS NOT NULL
  THEN least(incremento_total, {d(ru['max_total_increment_percent'])}) END AS inc_total_porcentaje FROM p3),
priced AS (SELECT *, CAST(round(CAST(CASE WHEN salari_mensual * (1 + inc_total_porcentaje / 100) IS NOT NULL
  THEN greatest(salari_mensual * (1 + inc_total_porcentaje / 100), {d(ru['min_salary_threshold'])}) END
  AS DECIMAL(20,6)), 2) AS DOUBLE) AS nou_salari FROM p4)"""

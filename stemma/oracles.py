"""DuckDB SQL giving the same result as each query in ``driver_queries``."""

ORACLES: dict[str, str] = {}

LOW = "a-zàâçéèêëîïôûùüÿñæœ"
UP = "A-ZÀÂÇÉÈÊËÎÏÔÛÙÜŸÑÆŒ"
UPW = "A-ZÀÂÄÇÉÈÊËÎÏÔÖÛÙÜŸÑÆŒ"
NW = r"(?:^|[^\p{L}\p{N}_])"


def slug(expr: str) -> str:
    body = rf"trim(regexp_replace(lower(strip_accents({expr})), '[^a-z0-9]+', '-', 'g'), '-')"
    return f"coalesce(nullif({body}, ''), 'untitled')"


def quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


FIRST4 = "array_to_string(string_split(string_split(text, chr(10))[1], ' ')[1:4], ' ')"

BACK_MATTER = (
    "(?i)imprimerie|abonnement|souscription|rue de la sorbonne|paraissant|whatman|"
    "le gérant|ouvriers syndiqués|cahier de la .{0,20}série"
)
MIXED = rf"(?i){NW}[{LOW}]+\d|{NW}\d+[{LOW}]{{2,}}"


def line_counts(source: str, key: str, text: str, broad: bool) -> str:
    """CTE body: key, n_lines and the six flag counts per document."""
    lead_num = UP if broad else UPW
    mark = r"^\s*[#>|]" if broad else r"^\s*\||^\s*[#>][^\s#>]"

    def n(pattern: str) -> str:
        return f"len(list_filter(ls, lambda l: regexp_matches(l, '{pattern}')))"

    return rf"""
    SELECT *, greatest(len(ls), 1) AS n_lines,
      {n(r'^\s{0,3}\d{1,3}\s+[' + lead_num + ']')} AS f0,
      {n(mark)} AS f1,
      {n(r'[\^\\\[\]]')} AS f2,
      {n(MIXED)} AS f3,
      {n(r'\S{26,}')} AS f4,
      {n(BACK_MATTER)} AS f5
    FROM (SELECT {key}, {text} AS body,
            list_filter(string_split({text}, chr(10)), lambda l: regexp_matches(l, '\S')) AS ls
          FROM {source})"""


TOP_FLAGS = """array_to_string(list_transform(list_sort(list_filter(
      [{'neg': -f0, 'pos': 0, 'name': 'LEAD-NUM'}, {'neg': -f1, 'pos': 1, 'name': 'LEAD-MD'},
       {'neg': -f2, 'pos': 2, 'name': 'CARET/BRKT'}, {'neg': -f3, 'pos': 3, 'name': 'MIX-AD'},
       {'neg': -f4, 'pos': 4, 'name': 'LONG-TOK'}, {'neg': -f5, 'pos': 5, 'name': 'BACK-MATTER'}],
      lambda e: e.neg < 0)), lambda e: e.name || ':' || (-e.neg)), ',')"""

GARBLED = rf"""list_filter(toks, lambda t:
      len(trim(lower(t), '''’')) >= 4 AND (
        (regexp_matches(t, '^.+[{UPW}]') AND regexp_matches(t, '[a-zß-öø-ÿ]'))
        OR (len(regexp_replace(trim(lower(t), '''’'), '[^\p{{L}}]', '', 'g')) >= 4 AND (
          NOT regexp_matches(trim(lower(t), '''’'), '[aeiouyàâäéèêëîïôöûùüÿœæ]')
          OR regexp_matches(regexp_replace(trim(lower(t), '''’'), '[^\p{{L}}]', '', 'g'), '[bcdfghjklmnpqrstvwxzçñ]{{5,}}')
          OR NOT coalesce(nullif(regexp_extract(trim(lower(t), '''’'), '([a-zà-ÿ])[''’][a-zà-ÿ]{{4,}}', 1), ''), 'c')
             IN ('c','d','j','l','m','n','s','t')))))"""

ACTIONS = """SELECT doc_id, CASE WHEN toxic = 1 THEN 'filter-blocked' WHEN quality = 1 THEN 'use-wikisource'
    ELSE 'skip' END AS action FROM labels"""


def ledger(scanned: str) -> str:
    return rf"""
  counts AS ({line_counts('documents', 'doc_id, source', 'text', False)}),
  toks AS (SELECT *, regexp_extract_all(body, '[A-Za-zÀ-ÿ''’]{{2,}}') AS toks FROM counts),
  meas AS (SELECT *, greatest(len(toks), 1) AS words, len({GARBLED}) AS garbled FROM toks),
  scored AS (SELECT *, (f0+f1+f2+f3+f4+f5)::DOUBLE / n_lines * 100 AS density,
      garbled::DOUBLE / words * 100 AS garble FROM meas),
  acts AS ({ACTIONS}),
  held AS (SELECT DISTINCT source FROM documents WHERE {scanned}),
  rows AS (SELECT s.doc_id, s.source, n_lines, words, density, garble,
      {slug("array_to_string(string_split(string_split(body, chr(10))[1], ' ')[1:4], ' ')")} AS piece_slug,
      {TOP_FLAGS} AS top_flags,
      CASE WHEN action = 'use-wikisource' THEN 'wikisource' WHEN action = 'filter-blocked' THEN 'filter-blk'
           WHEN action = 'skip' THEN 'skip' ELSE 'old-ocr' END AS status, held.source IS NOT NULL AS is_held
    FROM scored s LEFT JOIN acts USING (doc_id) LEFT JOIN held ON held.source = s.source),
  ledger AS (SELECT round_even(density + garble * 3, 1) AS score, round_even(garble, 2) AS garble_pct,
      round_even(density, 1) AS line_pct, status,
      CASE WHEN status IN ('old-ocr', 'filter-blk') THEN
        CASE WHEN contains(piece_slug, 'tion-the') OR contains(piece_slug, 'and-the') OR contains(piece_slug, 'eau')
               THEN 'back-matter' WHEN is_held THEN 'scanned' ELSE 'unscanned' END END AS bucket,
      doc_id AS doc, source AS cahier, piece_slug, n_lines AS lines, words, top_flags FROM rows)"""


ORACLES["noise_ledger"] = f"""WITH {ledger("n_chars > 12000")}
SELECT row_number() OVER (ORDER BY score DESC, doc) AS rank, * FROM ledger"""

ORACLES["ledger_totals"] = f"""WITH {ledger("n_chars > 20000")}
SELECT count(*) AS scored, count(*) FILTER (status IN ('old-ocr', 'filter-blk')) AS todo,
  count(*) FILTER (bucket = 'scanned') AS scanned, count(*) FILTER (bucket = 'unscanned') AS unscanned,
  count(*) FILTER (bucket = 'back-matter') AS back_matter FROM ledger"""

ORACLES["worst_documents"] = f"""WITH {ledger("n_chars > 20000")}
SELECT doc, score, garble_pct, status, top_flags FROM ledger
WHERE status IN ('old-ocr', 'filter-blk') ORDER BY score DESC, doc LIMIT 20"""

ORACLES["review_worklist"] = f"""WITH
  counts AS ({line_counts('documents', 'doc_id', 'text', True)}),
  scored AS (SELECT doc_id, n_lines, round_even((f0+f1+f2+f3+f4+f5)::DOUBLE / n_lines * 100
      + CASE WHEN f5 >= 2 THEN 15.0::DOUBLE ELSE 0.0::DOUBLE END, 1) AS score, {TOP_FLAGS} AS flags FROM counts),
  wanted AS (SELECT doc_id, quality FROM labels WHERE quality = 0 OR toxic = 1
      UNION ALL SELECT -doc_id - 1, quality FROM labels WHERE toxic = 1)
SELECT row_number() OVER (ORDER BY coalesce(score, -1) DESC, w.doc_id) AS rank, coalesce(score, -1.0::DOUBLE) AS score,
  w.doc_id AS doc, quality, coalesce(n_lines, 0)::BIGINT AS lines, coalesce(flags, 'MISSING') AS flags
FROM wanted w LEFT JOIN scored s ON s.doc_id = w.doc_id"""

SHORT_OK = quoted((
    "a à y ô an au ce ci de du en es et eu il je la le ma me mu ne ni nu on ou or pu sa se "
    "si su ta te tu un va vu ya ai as ah oh eh ça là où ès dû dé ré"
).split())
ROMANS = quoted("I II III IV V VI VII VIII IX X XI XII XIII XIV XV XVI XVII XVIII XIX XX XL L LX XC C CM D M".split())
CUES = (
    rf"(?i){NW}(?:Imprimerie|abonnement|souscription|exemplaires?|cahier de la (?:première|deuxième|troisième|"
    r"quatrième|cinquième|sixième|septième|huitième|neuvième|dixième|onzième|douzième|treizième|quatorzième|"
    r"quinzième) série|frais d''envoi|le numéro\s*:|le cahier\s*:)"
)
# Tokens between two blanks: every blank-separated token but the first and the last.
FLAGGED_LINES = rf"""
  lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l,
      generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
  toks AS (SELECT *, regexp_split_to_array(l, '\s') AS ws FROM lines WHERE regexp_matches(l, '\S')),
  sus AS (SELECT *, list_filter(ws[2:len(ws)-1], lambda s: regexp_full_match(s, '[A-Za-zÀ-ÿ]{{1,2}}')
      AND lower(s) NOT IN ({SHORT_OK}) AND s NOT IN ({ROMANS})
      AND (len(s) = 1 OR (regexp_matches(s, '[A-ZÀ-ÖØ-Þ]') AND NOT regexp_matches(s, '[a-zß-öø-ÿ]')))) AS sus FROM toks),
  flagged AS (SELECT doc_id AS doc, line_no, l, list_filter([
      CASE WHEN regexp_matches(l, '^\s{{0,3}}\d{{1,3}}\s+[{UP}]') THEN 'LEAD-NUM' END,
      CASE WHEN regexp_matches(l, '^\s*[#>|]') THEN 'LEAD-MD' END,
      CASE WHEN regexp_matches(l, '[\^\\]') THEN 'CARET' END,
      CASE WHEN regexp_matches(l, '[\[\]]') AND NOT contains(l, '![') AND NOT contains(l, '](') THEN 'BRACKET' END,
      CASE WHEN regexp_matches(l, '{NW}[A-Z{LOW}]+\d|{NW}\d+[A-Z{LOW}]{{2,}}') THEN 'MIX-AD' END,
      CASE WHEN regexp_matches(l, '{NW}[A-Za-zÀ-ÿ]{{26,}}(?:$|[^\p{{L}}\p{{N}}_])') THEN 'LONG-TOK' END,
      CASE WHEN regexp_matches(l, '{CUES}') THEN 'BACK-MATTER' END,
      CASE WHEN len(sus) > 0 THEN 'SHORTS(' || array_to_string(sus[1:6], ',') || ')' END],
      lambda f: f IS NOT NULL) AS flags FROM sus)"""

ORACLES["line_flags"] = f"""WITH {FLAGGED_LINES}
SELECT doc, line_no, array_to_string(flags, ',') AS flags, rtrim(l) AS text FROM flagged WHERE len(flags) > 0"""

ORACLES["flagged_line_counts"] = f"""WITH {FLAGGED_LINES}
SELECT doc, count(*) AS n FROM flagged WHERE len(flags) > 0 GROUP BY doc"""

FR_FN = quoted((
    "le la les de et qui que un une dans pour avec était elle il sur ses au aux "
    "comme son sa nous vous ce cette mais plus tout tous"
).split())
EN_FN = quoted("the and of to in that was with for on but as by at from this all or not are were".split())


def prose(source: str, key: str, text: str, lang: str) -> str:
    """CTE body: key, n_lines, prose_lines per document."""
    return rf"""
    SELECT {key}, len(ls) AS n_lines, len(list_filter(ls, lambda l:
        len(list_filter(regexp_extract_all(l, '[A-Z{LOW}]+'), lambda t: regexp_full_match(t, '[A-Z]?[{LOW}]{{2,}}'))) >= 2
        AND len(list_filter(regexp_extract_all(lower(l), '[\p{{L}}\p{{N}}_]+'),
              lambda t: CASE WHEN lang = 'fr' THEN t IN ({FR_FN}) ELSE t IN ({EN_FN}) END)) >= 1)) AS prose_lines
    FROM (SELECT {key}, {lang} AS lang,
            list_filter(string_split({text}, chr(10)), lambda l: regexp_matches(l, '\S')) AS ls FROM {source})"""


ORACLES["prose_audit"] = f"""WITH p AS ({prose('documents', 'doc_id', 'text', 'lang')})
SELECT doc_id AS doc, n_lines, prose_lines,
  CASE WHEN n_lines = 0 THEN 0.0::DOUBLE ELSE round_even(prose_lines::DOUBLE / n_lines, 3) END AS ratio,
  CASE WHEN prose_lines = 0 THEN 'EMPTY' WHEN prose_lines::DOUBLE / n_lines < 0.5 THEN 'LOW_PROSE' END AS flag
FROM p"""

ORACLES["word_counts"] = r"""SELECT doc_id, len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS words,
  len(list_filter(regexp_split_to_array(text, '\s+'), lambda t: t <> '')) AS tokens FROM documents"""

# --- document audit ------------------------------------------------------------------

PAIRED = """SELECT doc_id, 'c' || ((doc_id // 2) % 37) AS cahier, 'd' || (doc_id // 2) AS piece_slug,
    CASE WHEN doc_id % 2 = 0 THEN 'fr' ELSE 'en' END AS plang, n_chars, text FROM documents"""

FIRST6 = "array_to_string(string_split(string_split(text, chr(10))[1], ' ')[1:6], ' ')"

AUDIT = f"""
  paired AS ({PAIRED}),
  stats AS ({prose('paired', 'cahier, piece_slug, plang', 'text', 'plang')}),
  ratios AS (SELECT *, CASE WHEN n_lines = 0 THEN 0.0::DOUBLE ELSE prose_lines::DOUBLE / n_lines END AS ratio FROM stats),
  files AS (SELECT cahier, piece_slug,
      max(prose_lines) FILTER (plang = 'fr') AS fr_prose, max(ratio) FILTER (plang = 'fr') AS fr_ratio,
      max(prose_lines) FILTER (plang = 'en') AS en_prose, max(ratio) FILTER (plang = 'en') AS en_ratio
    FROM ratios GROUP BY ALL),
  declared AS (SELECT cahier, piece_slug, min_by({FIRST6}, doc_id) AS title,
      'a' || min_by(quality, doc_id) AS listed_author FROM paired JOIN labels USING (doc_id) GROUP BY ALL),
  upstream AS (SELECT cahier, max(coalesce(toxic, 0)) AS bad FROM paired LEFT JOIN labels USING (doc_id)
      WHERE n_chars > 6000 GROUP BY ALL),
  known AS (SELECT d.*, u.bad,
      CASE WHEN contains(title, 'Then') THEN 'a1' WHEN contains(title, 'ea ') THEN 'a0' WHEN contains(title, 'eau') THEN 'a9'
           WHEN contains(title, 'tion') THEN 'a1' WHEN contains(title, 'ung') THEN 'a0' END AS expected
    FROM declared d LEFT JOIN upstream u USING (cahier)),
  audit AS (SELECT coalesce(k.cahier, f.cahier) AS cahier, coalesce(k.piece_slug, f.piece_slug) AS piece_slug,
      coalesce(title, '') AS title, coalesce(listed_author, '') AS listed_author,
      CASE WHEN k.cahier IS NOT NULL THEN coalesce(fr_prose, 0) END AS fr_prose,
      CASE WHEN k.cahier IS NOT NULL THEN round_even(fr_ratio, 2) END AS fr_ratio,
      CASE WHEN k.cahier IS NOT NULL THEN coalesce(en_prose, 0) END AS en_prose,
      CASE WHEN k.cahier IS NOT NULL THEN round_even(en_ratio, 2) END AS en_ratio,
      CASE WHEN k.cahier IS NULL THEN 'ORPHAN_FILE' ELSE array_to_string(list_filter([
        CASE WHEN bad IS NULL THEN 'COM_MISSING' WHEN bad = 1 THEN 'COM_PLACEHOLDER' END,
        CASE WHEN regexp_matches(title, '^(La|The|Is) ') THEN 'SPLIT_SUSPECT' END,
        CASE WHEN fr_prose IS NULL THEN 'NO_FR' WHEN fr_prose = 0 THEN 'EMPTY_FR' WHEN fr_ratio < 0.5 THEN 'LOW_PROSE_FR' END,
        CASE WHEN en_prose IS NULL THEN 'NO_EN' WHEN en_prose = 0 THEN 'EMPTY_EN' WHEN en_ratio < 0.5 THEN 'LOW_PROSE_EN' END,
        CASE WHEN expected <> listed_author THEN 'AUTHOR_MISMATCH(' || listed_author || '→' || expected || ')' END],
        lambda f: f IS NOT NULL), '|') END AS flags
    FROM known k FULL JOIN files f ON k.cahier = f.cahier AND k.piece_slug = f.piece_slug),
  each AS (SELECT cahier || '--' || piece_slug AS doc, title, string_split(unnest(string_split(flags, '|')), '(')[1] AS flag
    FROM audit WHERE flags <> '')"""

ORACLES["audit_documents"] = f"WITH {AUDIT} SELECT * FROM audit"

ORACLES["flag_histogram"] = f"WITH {AUDIT} SELECT flag, count(*) AS n FROM each GROUP BY flag"

ORACLES["flag_report_top50"] = f"""WITH {AUDIT},
  numbered AS (SELECT flag AS section, row_number() OVER (PARTITION BY flag ORDER BY doc) AS pos,
      '- ' || doc || ': ' || title AS line, count(*) OVER (PARTITION BY flag) AS n FROM each)
SELECT section, pos, line FROM numbered WHERE pos <= 50
UNION ALL SELECT DISTINCT section, 51, '- ... and ' || (n - 50) || ' more' FROM numbered WHERE n > 50"""

ORACLES["declared_vs_files"] = """SELECT coalesce(l.doc_id, d.doc_id) AS doc_id,
  CASE WHEN l.doc_id IS NULL THEN 'ORPHAN_FILE' WHEN d.doc_id IS NULL THEN 'NO_FILE' ELSE 'OK' END AS state
FROM labels l FULL JOIN (SELECT doc_id FROM documents WHERE n_chars > 1500) d ON l.doc_id = d.doc_id"""

ORACLES["missing_references"] = """
SELECT o_orderkey, 'customer' AS field, o_custkey * 2 AS ref FROM orders
WHERE o_custkey * 2 NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT o_orderkey, 'supplier', o_custkey % 150 FROM orders
WHERE o_custkey % 150 NOT IN (SELECT s_suppkey FROM supplier)"""

ORACLES["lang_pivot"] = f"""WITH p AS (SELECT cahier, piece_slug,
    bool_or(n_chars > 900 AND plang = 'fr') AS fr, bool_or(n_chars > 900 AND plang = 'en') AS en
  FROM ({PAIRED}) GROUP BY ALL)
SELECT *, CASE WHEN en THEN 'en' WHEN fr THEN 'fr' END AS primary_en, CASE WHEN fr AND en THEN 'fr' END AS other_en,
  CASE WHEN fr THEN 'fr' WHEN en THEN 'en' END AS primary_fr, CASE WHEN fr AND en THEN 'en' END AS other_fr,
  NOT fr AND NOT en AS is_pending FROM p"""

# --- planning ------------------------------------------------------------------------

ORACLES["source_inventory"] = rf"""WITH src AS (
  SELECT source AS cahier, 'org-piece' AS type, 'pieces/' || doc_id || '.md' AS path,
    replace(replace(replace(text, 'tion ', 'tion-' || chr(10)), 'er ', 'er7' || chr(10)), '. ', ' [?] ') AS text FROM documents
  UNION ALL SELECT 'src' || (page_id % 20), 'com-cahier', 'texts/' || page_id || '.md', html FROM pages
  UNION ALL SELECT 'src' || (conv_id % 20), 'slug-fallback', 'raw/' || conv_id || '-' || turn || '-' || role || '.txt', text
    FROM conversations WHERE NOT regexp_matches(conv_id || '-' || turn || '-' || role, '-(system|extra)'))
SELECT cahier, type, path,
  len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '\S'))) AS lines,
  len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[{LOW}]-\s*$'))) AS hyph_end,
  len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[{LOW}]\d{{1,4}}\s*$'))) AS pgnum_end,
  len(regexp_extract_all(text, '{NW}[{LOW}]+[''"\\][a-zA-Z0-9]')) AS weird,
  len(regexp_extract_all(text, '\[\?\]')) AS qmark, strlen(text) AS bytes FROM src"""

PLAN = f"""
  docs AS (SELECT doc_id AS doc, 'c' || (doc_id % 7) AS cahier, {slug(FIRST4)} AS piece_slug, source AS author,
      {FIRST6} AS title FROM documents),
  tiers(author, tier) AS (VALUES ('src0', 'T1'), ('src1', 'T1'), ('src2', 'T2'), ('src3', 'T2'), ('src4', 'T2')),
  exact AS (SELECT author, piece_slug, 'Doc_' || min(doc) AS url FROM docs JOIN labels ON doc_id = doc
      WHERE quality = 1 AND toxic = 1 GROUP BY ALL),
  chosen AS (SELECT d.doc, d.cahier, d.piece_slug, d.author, coalesce(t.tier, 'T3') AS tier, CASE
      WHEN e.url IS NOT NULL THEN {{'u': e.url, 's': 'validated', 'a': 'use-wikisource'}}
      WHEN (d.author = 'src0' AND (contains(title, 'The') OR contains(title, 'er '))) OR (d.author = 'src1' AND contains(title, 'Of'))
        THEN {{'u': '', 's': '', 'a': 'skip-editorial'}}
      WHEN d.author = 'src1' AND contains(d.piece_slug, 'and-the') THEN {{'u': 'Page_A', 's': 'proofread', 'a': 'use-wikisource'}}
      WHEN d.author = 'src1' AND contains(d.piece_slug, 'tion') THEN {{'u': 'Page_B', 's': 'validated', 'a': 'use-wikisource'}}
      WHEN d.author = 'src3' AND contains(d.piece_slug, 'the') THEN {{'u': 'Page_C', 's': 'proofread', 'a': 'use-wikisource'}}
      WHEN d.author = 'src1' AND d.cahier = 'c5' THEN {{'u': 'Page_D', 's': 'validated', 'a': 'use-wikisource-jc'}}
      WHEN d.author = 'src2' AND d.cahier = 'c1' THEN {{'u': 'Page_E', 's': 'validated', 'a': 'use-wikisource-jc'}}
      ELSE {{'u': '', 's': '', 'a': CASE WHEN d.author = 'src0' THEN 'verify-first' WHEN d.author = 'src1' THEN 'verify-second'
        WHEN t.tier = 'T2' THEN 'check-wikisource' ELSE 'skip' END}} END AS c
    FROM docs d LEFT JOIN tiers t ON t.author = d.author
    LEFT JOIN exact e ON e.author = d.author AND e.piece_slug = d.piece_slug),
  plan AS (SELECT doc, cahier, piece_slug, author, tier,
      CASE WHEN c.u = '' THEN '' ELSE 'https://example.org/wiki/' || c.u END AS url, c.s AS status, c.a AS action FROM chosen)"""

ORACLES["source_plan"] = f"WITH {PLAN} SELECT * FROM plan"
ORACLES["plan_counts"] = f"""WITH {PLAN}
SELECT 'tier' AS category, tier AS value, count(*) AS n FROM plan GROUP BY ALL
UNION ALL SELECT 'action', action, count(*) FROM plan GROUP BY ALL
UNION ALL SELECT 'status', status, count(*) FROM plan GROUP BY ALL"""

ORACLES["candidate_verdicts"] = r"""WITH
  toks AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda t: t <> '') AS ts FROM documents),
  btoks AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda t: t <> '') AS ts FROM benchmark),
  dg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(ts) - 3), lambda i: array_to_string(ts[i:i+4], ' '))) AS g FROM toks),
  bg AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(ts) - 3), lambda i: array_to_string(ts[i:i+4], ' '))) AS g FROM btoks),
  pairs AS (SELECT DISTINCT item_id, doc_id FROM dg JOIN bg USING (g)),
  want AS (SELECT item_id, list_distinct(regexp_extract_all(lower(regexp_extract(text, '^[^.\n]*')), '[\p{L}\p{N}_]{4,}')) AS w FROM benchmark),
  cand AS (SELECT p.item_id, p.doc_id, d.text, quality,
      len(list_filter(regexp_split_to_array(d.text, '\s+'), lambda t: t <> '')) AS wc,
      len(list_intersect(w, list_distinct(regexp_extract_all(lower(d.text), '[\p{L}\p{N}_]{4,}'))))::DOUBLE / greatest(len(w), 1) AS share
    FROM pairs p JOIN want USING (item_id) JOIN documents d ON d.doc_id = p.doc_id LEFT JOIN labels l ON l.doc_id = p.doc_id),
  hit AS (SELECT item_id, min_by(text, doc_id) AS best, min_by(CASE WHEN quality = 1 THEN 'FOUND-validated'
      WHEN quality = 0 THEN 'FOUND-proofread' ELSE 'FOUND-maybe' END, doc_id) AS verdict
    FROM cand WHERE wc > 300 AND share >= 0.5 GROUP BY item_id)
SELECT b.item_id AS wanted, coalesce(verdict, 'NONE') AS verdict, md5(coalesce(best, '')) AS best_md5,
  CASE coalesce(verdict, 'NONE') WHEN 'FOUND-validated' THEN 0 WHEN 'FOUND-proofread' THEN 1 WHEN 'FOUND-maybe' THEN 2 ELSE 3 END::BIGINT AS verdict_order
FROM benchmark b LEFT JOIN hit h USING (item_id)"""

ORACLES["resolve_names"] = rf"""WITH RECURSIVE
  arrivals AS (
    SELECT replace(c_name, 'C', 'Ç') AS name, c_custkey * 4 AS ord FROM customer
    UNION ALL SELECT lower(c_name) || c_mktsegment[1:2], c_custkey * 4 + 1 FROM customer WHERE c_nationkey > 12
    UNION ALL SELECT replace(c_name[9:20], '#', 'Supplier#') || '-', c_custkey * 4 + 2 FROM customer WHERE c_nationkey < 6
    UNION ALL SELECT 'Anonymous', c_custkey * 4 + 3 FROM customer WHERE c_acctbal < 0),
  spelled AS (SELECT name, lower(strip_accents(name)) AS norm, min(ord) AS ord FROM arrivals GROUP BY ALL),
  entries AS (
    SELECT lower(s_name) AS norm, 0 AS late, s_suppkey AS spot, 's-' || s_suppkey AS slug, NULL::VARCHAR AS name FROM supplier
    UNION ALL SELECT norm, 1, min(ord), NULL::VARCHAR, min(name) FROM spelled
      WHERE norm NOT IN (SELECT lower(s_name) FROM supplier) GROUP BY norm),
  trims AS (SELECT DISTINCT norm, norm[1 + a : len(norm) - b] AS part
    FROM entries, (SELECT a, b FROM range(4) r(a), range(4) q(b) WHERE a + b BETWEEN 1 AND 3)),
  pairs AS (SELECT l.norm AS a, s.norm AS b, l.late AS la, l.spot AS ta, s.late AS lb, s.spot AS tb
    FROM trims t JOIN entries s ON s.norm = t.part JOIN entries l ON l.norm = t.norm WHERE l.norm <> s.norm),
  looks AS (SELECT a AS me, la, ta, b AS other, lb, tb FROM pairs UNION SELECT b, lb, tb, a, la, ta FROM pairs),
  up AS (SELECT me, arg_min(other, (lb, tb, other)) AS other FROM looks
    WHERE la = 1 AND (lb, tb, other) < (la, ta, me) GROUP BY me),
  walk AS (
    SELECT norm, norm AS spot FROM entries
    UNION ALL SELECT w.norm, u.other FROM walk w JOIN up u ON u.me = w.spot),
  roots AS (SELECT norm, spot FROM walk WHERE spot NOT IN (SELECT me FROM up))
SELECT s.name, coalesce(e.slug, {slug('e.name')}) AS slug, (e.slug IS NULL AND r.norm = r.spot) AS is_new
FROM (SELECT DISTINCT name, norm FROM spelled) s JOIN roots r ON r.norm = s.norm JOIN entries e ON e.norm = r.spot"""

ORACLES["slug_dedupe"] = f"""WITH b AS (SELECT p_partkey, p_brand, {slug('p_name')} AS base FROM part),
  n AS (SELECT *, row_number() OVER (PARTITION BY p_brand, base ORDER BY p_partkey) AS k FROM b)
SELECT p_partkey, p_brand, CASE WHEN k = 1 THEN base ELSE base || '-' || k END AS slug FROM n"""

ORACLES["url_views"] = r"""WITH p AS (SELECT page_id, regexp_extract(url, '^https?://[^/]+([^?#]*)', 1) AS path,
    replace(regexp_extract(html, '<title>([^<]*)</title>', 1), ' ', '_') AS title,
    ['about', 'authors', 'works', 'cahiers', 'x'][page_id % 5 + 1] AS en_seg,
    ['a-propos', 'auteurs', 'oeuvres', 'cahiers', 'x'][page_id % 5 + 1] AS fr_seg FROM pages),
  q AS (SELECT *, path IN ('/fr', '/fr/') OR path LIKE '/fr/%' AS is_fr,
    array_to_string(list_filter(string_split(path, '/'), lambda s: s <> ''), '/') AS parts,
    array_to_string(list_filter(string_split(regexp_replace(path, '^/fr', ''), '/'), lambda s: s <> ''), '/') AS bare FROM p)
SELECT page_id, path, is_fr, CASE WHEN path IN ('', '/') THEN '/fr/' WHEN is_fr THEN path ELSE '/fr/' || parts END AS fr_path,
  CASE WHEN is_fr THEN '/' || bare ELSE path END AS en_path, '/fr/' || fr_seg || '/' || page_id AS fr_inner,
  '/' || en_seg || '/' || page_id AS en_inner, title,
  CASE WHEN is_fr THEN '/fr' ELSE '' END || '/cahiers/s01-c01/' || page_id || '/fr' AS piece_url,
  CASE WHEN is_fr THEN '/fr' ELSE '' END || '/cahiers/' || page_id AS cahier_url,
  CASE WHEN is_fr THEN '/fr/auteurs/' ELSE '/authors/' END || page_id AS author_url,
  CASE WHEN is_fr THEN '/fr/oeuvres/' ELSE '/works/' END || page_id AS work_url FROM q"""

# --- reading views --------------------------------------------------------------------

ISSUES = """SELECT 'o' || o_orderkey AS slug, o_orderpriority[1]::INT AS series, o_orderkey AS issue,
    CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS date FROM orders"""
ROMAN = "['I', 'II', 'III', 'IV', 'V'][series]"

ORACLES["river"] = f"""WITH i AS ({ISSUES}),
  f AS (SELECT *, last_value(date IGNORE NULLS) OVER (ORDER BY series, issue ROWS UNBOUNDED PRECEDING) AS od FROM i),
  n AS (SELECT *, row_number() OVER (ORDER BY od NULLS FIRST, series, issue) AS river_no FROM f),
  y AS (SELECT series, min_by(date[1:4], river_no) FILTER (date IS NOT NULL) AS series_year FROM n GROUP BY series)
SELECT river_no, n.series, slug, issue, date,
  (lag(n.series) OVER (ORDER BY river_no)) IS DISTINCT FROM n.series AS is_series_start,
  {ROMAN.replace('series', 'n.series')} AS series_roman, series_year FROM n JOIN y USING (series)"""

ORACLES["river_dated"] = """WITH n AS (SELECT 'o' || o_orderkey AS slug, o_orderpriority[1]::INT AS series,
    row_number() OVER (ORDER BY o_orderdate, o_orderpriority[1], o_orderkey) AS river_no FROM orders)
SELECT river_no, series, slug, (lag(series) OVER (ORDER BY river_no)) IS DISTINCT FROM series AS is_series_start FROM n"""

ORACLES["issue_neighbours"] = f"""SELECT slug, lag(slug) OVER w AS prev_slug, lead(slug) OVER w AS next_slug
FROM ({ISSUES}) WINDOW w AS (ORDER BY series, issue)"""

ORACLES["series_overview"] = f"""SELECT series, min_by(slug, issue) AS first_slug,
  min_by(date[1:4], issue) FILTER (date IS NOT NULL) AS year, {ROMAN} AS roman FROM ({ISSUES}) GROUP BY series"""

VIEWS = """
  declared AS (SELECT 'k' || o_custkey AS cahier, o_orderkey AS pos, 'o' || o_orderkey AS piece_slug,
      o_orderpriority AS title, 's' || (o_custkey % 1200) AS author, o_orderstatus = 'P' AS is_notice,
      o_orderstatus, o_totalprice FROM orders),
  langs AS (SELECT cahier, piece_slug, o_orderstatus IN ('F', 'P') AS fr, o_orderstatus NOT IN ('F') AS en
      FROM declared WHERE o_totalprice > 60000),
  issues AS (SELECT 'k' || c_custkey AS slug, c_nationkey AS series, c_custkey AS issue, c_name AS label FROM customer),
  authors AS (SELECT 's' || s_suppkey AS slug, s_name AS name, s_acctbal > 5000 AS is_editor FROM supplier)"""

ORACLES["cahier_view"] = f"""WITH {VIEWS},
  nb AS (SELECT slug, lag(slug) OVER w AS prev, lead(slug) OVER w AS next FROM issues WINDOW w AS (ORDER BY series, issue))
SELECT d.cahier, d.pos, d.piece_slug, coalesce(a.name, d.author) AS author_name,
  CASE WHEN l.en THEN 'en' WHEN l.fr THEN 'fr' END AS primary_lang, CASE WHEN l.en AND l.fr THEN 'fr' END AS other_lang,
  l.fr IS NULL AS is_pending, prev, next
FROM declared d LEFT JOIN authors a ON a.slug = d.author LEFT JOIN langs l USING (cahier, piece_slug)
LEFT JOIN nb ON nb.slug = d.cahier"""

ORACLES["piece_view"] = f"""WITH {VIEWS},
  nb AS (SELECT cahier, piece_slug, lag(piece_slug) OVER w AS prev_piece, lead(piece_slug) OVER w AS next_piece
      FROM declared WINDOW w AS (PARTITION BY cahier ORDER BY pos)),
  texts AS (SELECT d.cahier, piece_slug, author, fr AND en AS both_langs, unnest(list_filter([CASE WHEN fr THEN 'fr' END,
      CASE WHEN en THEN 'en' END], lambda x: x IS NOT NULL)) AS lang FROM declared d JOIN langs USING (cahier, piece_slug))
SELECT t.cahier, i.label, t.piece_slug, t.lang, coalesce(a.name, t.author) AS author_name,
  t.both_langs AS other_lang_exists, prev_piece, next_piece
FROM texts t JOIN nb USING (cahier, piece_slug) LEFT JOIN authors a ON a.slug = t.author LEFT JOIN issues i ON i.slug = t.cahier"""

CONTRIB = f"""{VIEWS},
  contrib AS (SELECT a.slug AS author, CASE WHEN d.cahier IS NULL THEN NULL WHEN is_editor AND is_notice THEN 'notice'
      ELSE 'writing' END AS kind, series, issue, d.cahier, pos, d.piece_slug,
      CASE WHEN d.cahier IS NOT NULL THEN coalesce(fr, false) END AS fr, CASE WHEN d.cahier IS NOT NULL THEN coalesce(en, false) END AS en
    FROM authors a LEFT JOIN declared d ON d.author = a.slug LEFT JOIN langs l ON l.cahier = d.cahier AND l.piece_slug = d.piece_slug
    LEFT JOIN issues i ON i.slug = d.cahier)"""

ORACLES["author_contributions"] = f"WITH {CONTRIB} SELECT * FROM contrib"
ORACLES["contribution_counts"] = f"""WITH {CONTRIB}
SELECT author, count(piece_slug) AS n, count(*) FILTER (kind = 'notice') AS n_notices FROM contrib GROUP BY author"""

ORACLES["author_index"] = """SELECT 'k' || c_custkey AS slug, c_name AS name,
  CASE WHEN c_nationkey > 3 THEN split_part(c_name, '#', 2) || ', ' || split_part(c_name, '#', 1) ELSE c_name END AS sort_key,
  c_mktsegment = 'BUILDING' AS is_editor,
  CASE WHEN c_acctbal > 0 OR c_nationkey > 10 THEN
    coalesce(CASE WHEN c_acctbal > 0 THEN (floor(c_acctbal / 10)::BIGINT + 1000)::VARCHAR END, '?') || '–' ||
    coalesce(CASE WHEN c_nationkey > 10 THEN (c_nationkey + 1900)::VARCHAR END, '?') END AS years FROM customer"""

ORACLES["notice_targets"] = """WITH d AS (SELECT o_orderkey AS k, 'g' || (o_orderkey // 20) AS cahier, o_orderpriority AS title,
    o_orderstatus = 'P' AND o_totalprice > 60000 AS notice FROM orders)
SELECT a.cahier, 'o' || a.k AS piece_slug, 'o' || b.k AS target, b.title AS target_title
FROM d a JOIN d b ON a.cahier = b.cahier AND b.k = a.k + a.k % 7 - 3 WHERE a.notice"""

ORACLES["work_parts"] = f"""WITH {VIEWS},
  parts AS (SELECT 'w' || conv_id AS work, turn, CASE WHEN role = 'user' THEN 'k' || o_custkey ELSE 'k?' END AS cahier,
      'o' || (conv_id * 10 + turn) AS piece_slug, CASE WHEN role = 'system' THEN 'Prologue' END AS label
    FROM conversations LEFT JOIN orders ON o_orderkey = conv_id * 10 + turn)
SELECT work, turn + 1 AS part_no, coalesce(p.label, d.title, p.piece_slug) AS title, i.label AS cahier_label, p.cahier,
  p.piece_slug, coalesce(l.fr, false) AS fr, coalesce(l.en, false) AS en
FROM parts p LEFT JOIN declared d USING (cahier, piece_slug) LEFT JOIN langs l USING (cahier, piece_slug)
LEFT JOIN issues i ON i.slug = p.cahier"""

ORACLES["works_of_issues"] = """SELECT 'k' || o_custkey AS cahier, 'w' || conv_id AS work,
  array_to_string(string_split(string_split(text, chr(10))[1], ' ')[1:3], ' ') AS title
FROM orders JOIN conversations ON conv_id = o_orderkey WHERE turn = 0"""

# --- corrections and merges -----------------------------------------------------------

FIRST5 = "array_to_string(string_split(string_split(text, chr(10))[1], ' ')[1:5], ' ')"
CORRECT = f"""
  p AS (SELECT source AS cahier, 'd' || doc_id AS piece_slug, doc_id AS pos, {FIRST5} AS title, lang AS author,
      quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
  c AS (SELECT *, CASE cahier WHEN 'src1' THEN replace(own_title, 'The', 'A') WHEN 'src2' THEN replace(own_title, 'tion', '-')
      WHEN 'src3' THEN replace(own_title, '3', '') ELSE own_title END AS new_title,
      CASE WHEN toxic = 1 THEN 'toxic' ELSE author END AS new_author
    FROM (SELECT *, CASE WHEN quality = 0 THEN replace(replace(title, 'e', 'E'), 'E', '3') ELSE title END AS own_title FROM p)),
  ends AS (SELECT cahier, max(pos) AS last FROM p GROUP BY cahier),
  adds AS (SELECT cahier, 'new-' || piece_slug AS piece_slug,
      last + row_number() OVER (PARTITION BY cahier ORDER BY 'new-' || piece_slug) AS pos, 'Added ' || piece_slug AS title,
      'added' AS author FROM p JOIN ends USING (cahier) WHERE toxic = 1)"""
ORACLES["apply_corrections"] = f"""WITH {CORRECT}
SELECT cahier, piece_slug, pos, new_title AS title, new_author AS author FROM c
UNION ALL SELECT cahier, piece_slug, pos, title, author FROM adds"""
ORACLES["correction_log"] = f"""WITH {CORRECT}
SELECT cahier, piece_slug, 'title' AS field, title AS old, new_title AS new FROM c WHERE title <> new_title
UNION ALL SELECT cahier, piece_slug, 'author', author, new_author FROM c WHERE author <> new_author
UNION ALL SELECT cahier, piece_slug, 'piece', NULL, title FROM adds"""

COPIES = """first AS (SELECT lang, md5(text) AS h, min(doc_id) AS keep, count(*) AS n FROM documents GROUP BY ALL HAVING count(*) > 1)"""
ORACLES["merge_duplicates"] = f"""WITH {COPIES}
SELECT d.lang AS cahier, 'd' || doc_id AS piece_slug, doc_id AS pos, coalesce('Kept of ' || n, {FIRST5}) AS title
FROM documents d LEFT JOIN first f ON f.lang = d.lang AND f.h = md5(text) WHERE keep IS NULL OR keep = doc_id"""
ORACLES["drop_documents"] = f"""WITH {COPIES}
SELECT d.lang AS cahier, 'd' || doc_id AS piece_slug
FROM documents d LEFT JOIN first f ON f.lang = d.lang AND f.h = md5(text) WHERE keep IS NULL OR keep = doc_id"""

# --- leaves -----------------------------------------------------------------------------

ORACLES["leaf_manifest"] = """WITH w AS (SELECT p_partkey AS id, p_size AS first,
    unnest(range(p_size, p_size + p_partkey % 60 + 1)) AS leaf FROM part)
SELECT id, leaf::INT AS leaf, ((leaf - first) // 26 + 1)::INT AS batch FROM w
WHERE (id, leaf) NOT IN (SELECT (l_partkey, l_quantity::BIGINT) FROM lineitem)"""

ORACLES["batch_ranges"] = """WITH w AS (SELECT p_partkey AS id, p_size + p_partkey % 60 AS last, p_size AS f,
    unnest(range(0, (p_partkey % 60) // 26 + 1)) AS k, ((p_partkey % 60) // 26 + 1)::INT AS batches FROM part WHERE p_partkey % 60 > 0)
SELECT id, (k + 1)::INT AS batch, (f + k * 26)::INT AS first, least(f + k * 26 + 25, last)::INT AS last, batches FROM w"""

ORACLES["batch_status"] = """SELECT l_orderkey AS id, (l_orderkey % 4 + 1)::INT AS batches,
  count(*) FILTER (l_returnflag <> 'R') AS parts_saved,
  CASE WHEN count(*) FILTER (l_returnflag <> 'R' AND NOT l_discount > 0.08) = l_orderkey % 4 + 1 THEN 'done'
       WHEN bool_or(l_discount > 0.08) THEN 'filter-blocked' ELSE 'batch-failed' END AS status
FROM lineitem GROUP BY l_orderkey"""

# --- cleaning -----------------------------------------------------------------------------

NOISY = r"""SELECT doc_id AS doc, '[leaf 12]' || chr(10) || '145' || repeat(chr(10), 3) ||
    replace(replace(replace(replace(text, 'tion ', 'tion-' || chr(10)), 'er ', 'er12' || chr(10) || chr(10)),
      '. ', '. 4' || chr(10)), ', ', ', k 5e ') || chr(10) || '1903, 12.50' || chr(10) || text[1:30] ||
    ' RU I] ''42 52 | M. x' || chr(10) || '#> de la' || repeat(chr(10), 2) AS body FROM documents"""
BRK = r"[ \t]*\n(?:[ \t]*\n)*"
NUM = (
    rf"([{LOW}]{{3}})\d{{1,4}}{BRK}([{LOW}])|([{LOW}]{{2}})\d{{1,4}}{BRK}([{LOW}]{{2}})|([{LOW}])\d{{1,4}}{BRK}([{LOW}]{{3}})"
)


def repeat_replace(expr: str, pattern: str, to: str, times: int) -> str:
    for _ in range(times):
        expr = f"regexp_replace({expr}, '{pattern}', '{to}', 'g')"
    return expr


HYPH = rf"([{LOW}]{{2}})-{BRK}([{LOW}]{{2}})"
HEALED = f"""noisy AS ({NOISY}),
  numbered AS (SELECT doc, body AS raw, {repeat_replace('body', NUM, r'\1\2\3\4\5\6', 4)} AS body FROM noisy),
  healed AS (SELECT doc, raw, {repeat_replace('body', HYPH, r'\1\2', 3)} AS body FROM numbered)"""

ORACLES["heal_breaks"] = f"WITH {HEALED} SELECT doc, body FROM healed"

LET = LOW + UP
PROSE_FR = quoted((
    "le la les l un une des du de et ou mais donc car ni que qui quoi dans sur sous avec sans pour par vers chez entre "
    "il elle ils elles on nous vous je tu moi toi lui leur son sa ses mon ma mes ton ta tes notre votre nos vos "
    "ce cette ces cet est était sont étaient fut furent sera seront avait avaient ont avez avons "
    "pas ne plus déjà encore toujours jamais comme quand où puis alors ainsi aussi même très bien tant tout tous toute toutes "
    "fait faire dit dire voir vu homme femme enfant jour nuit temps année vie monde pays "
    "père mère fils fille frère sœur christophe olivier antoinette rolland"
).split())
ONE_OK = quoted("a à y o ô é è ê ï ù".split())
TWO_OK = quoted((
    "le la de du et ou ce se me te ne ni on en au si il je tu ma ta sa où oh ah eh ai as es an un à y").split())
TAIL = (
    rf"\s+[*\-–—|:;,.]?\s*(?:[0-9][0-9{LET}]{{0,2}}|[{LET}][0-9][0-9{LET}]?|[{LET}]{{2}}[0-9]|"
    rf"[b-xzB-XZ{LET[3:].replace('A-Z', '').replace('à', '').replace('À', '')}])[.,;:!?]?"
)
DENOISED = rf"""{HEALED},
  lines AS (SELECT doc, unnest(string_split(regexp_replace(body, '\n$', ''), chr(10))) AS line,
      generate_subscripts(string_split(regexp_replace(body, '\n$', ''), chr(10)), 1) AS i FROM healed),
  bare AS (SELECT *, trim(line) AS b, regexp_replace(trim(line), '^(?:\|\s*)+', '') AS t FROM lines),
  runs AS (SELECT *, regexp_extract_all(t, '[{LET}]+') AS rs,
      len(list_filter(string_split(t, ' '), lambda w: regexp_matches(w, '\p{{L}}'))) AS toks FROM bare),
  facts AS (SELECT *, list_filter(rs, lambda r: regexp_full_match(r, '[{UP}]?[{LOW}]{{3,}}')) AS real,
      len(list_filter(rs, lambda r: r IN ({PROSE_FR}))) > 0 AS hit, len(array_to_string(rs, '')) AS letters FROM runs),
  verdict AS (SELECT *, CASE WHEN b = '' OR b LIKE '---%' OR b LIKE '```%' THEN false WHEN t = '' THEN true
      WHEN starts_with(t, '[leaf') OR starts_with(t, '[COLOPHON') OR starts_with(t, '[BACK-MATTER')
        OR starts_with(t, '[GUIEYSSE') OR starts_with(t, '[p.') THEN true
      WHEN regexp_full_match(t, '\d{{1,4}}') THEN true WHEN regexp_full_match(t, '[\d\s.,\-–—]+') THEN false
      WHEN letters = 0 THEN true WHEN toks >= 5 AND len(real)::DOUBLE / toks < 0.4 THEN true
      WHEN len(real) >= 3 AND letters::DOUBLE / len(t) >= 0.55 AND (hit OR len(list_filter(real, lambda w: len(w) >= 5)) > 0) THEN false
      WHEN len(real) >= 2 AND hit AND letters::DOUBLE / len(t) >= 0.5 THEN false
      WHEN len(real) >= 1 AND hit AND letters::DOUBLE / len(t) >= 0.65 AND len(t) <= 40
        AND len(list_filter(real, lambda w: len(w) >= 4)) > 0 THEN false ELSE true END AS noise FROM facts),
  marks AS (SELECT doc, i, list_filter(string_split(regexp_replace(regexp_replace(line, '^\d{{1,3}}\s+([{UP}])', '\1'), '^[#>]+\s*', ''), ' '),
      lambda w: w = '' OR NOT CASE
        WHEN regexp_matches(w, '\d') AND regexp_matches(w, '\p{{L}}') AND len(w) <= 5 THEN true
        WHEN regexp_full_match(w, '[''‘’`]\d{{1,4}}[.,;:''‘’`]?') THEN true
        WHEN len(w) = 2 AND regexp_matches(w, '\p{{L}}') AND regexp_matches(w, '[^\p{{L}}\p{{N}}.]') THEN true
        WHEN contains(w, '.') THEN false
        WHEN NOT regexp_matches(w, '[\p{{L}}\d]') THEN w NOT IN (',', ';', ':', '!', '?', '—', '–', '-', '…', '«', '»', '(', ')')
        WHEN len(w) = 1 AND regexp_matches(w, '\p{{L}}') THEN lower(w) NOT IN ({ONE_OK})
        WHEN len(w) = 2 AND regexp_full_match(w, '\p{{L}}{{2}}') THEN lower(w) NOT IN ({TWO_OK}) ELSE false END) AS ws
    FROM verdict WHERE NOT noise),
  tidy AS (SELECT doc, i, regexp_replace(trim(regexp_replace(regexp_replace(array_to_string(ws, ' '), ' {{2,}}', ' ', 'g'),
      '\s+([.,;:!?])', '\1', 'g')), '(?:{TAIL}){{0,4}}\s*$', '') AS l FROM marks),
  joined AS (SELECT doc, regexp_replace(regexp_replace(string_agg(l, chr(10) ORDER BY i), '\n{{3,}}', chr(10) || chr(10), 'g'),
      '^\n+|\n+$', '', 'g') AS body FROM tidy GROUP BY doc),
  denoised AS (SELECT v.doc, coalesce(j.body, '') || chr(10) AS body,
      CASE WHEN coalesce(j.body, '') = '' THEN 0 ELSE len(string_split(j.body, chr(10))) END AS kept, dropped
    FROM (SELECT doc, count(*) FILTER (noise) AS dropped FROM verdict GROUP BY doc) v LEFT JOIN joined j USING (doc))"""

ORACLES["denoise"] = f"WITH {DENOISED} SELECT doc, body, kept, dropped FROM denoised"
ORACLES["denoise_preview"] = rf"""WITH {DENOISED}
SELECT doc, len(string_split(n.body, chr(10))) AS lines_before, len(regexp_extract_all(n.body, '[\p{{L}}\p{{N}}_]+')) AS words_before,
  kept AS lines_after, len(regexp_extract_all(d.body, '[\p{{L}}\p{{N}}_]+')) AS words_after, dropped
FROM noisy n JOIN denoised d USING (doc)"""


def chain(expr: str, steps: list[tuple[str, str]]) -> str:
    for pattern, to in steps:
        p, t = pattern.replace("'", "''"), to.replace("'", "''")
        expr = f"regexp_replace({expr}, '{p}', '{t}', 'g')"
    return expr


FURNITURE = [
    (r"(?s)<table.*?</table>", ""),
    (r'(?s)<div[^>]*class="[^"]*(?:ad|sidebar)[^"]*".*?</div>', ""),
    (r"(?s)<style.*?</style>", ""),
    (r'(?s)<sup[^>]*class="[^"]*reference[^"]*".*?</sup>', ""),
    (r'(?s)<span[^>]*class="[^"]*pagenum[^"]*"[^>]*>.*?</span>', ""),
]
MARKUP = [
    (r"(?s)<script.*?</script>|<!--.*?-->|<head>.*?</head>", ""),
    (r"(?i)<h1[^>]*>", "\n\n# "), (r"(?i)<h2[^>]*>", "\n\n## "), (r"(?i)<h3[^>]*>", "\n\n### "), (r"(?i)<h4[^>]*>", "\n\n#### "),
    (r"(?i)<br[^>]*>", "\n"), (r"(?i)<hr[^>]*>", "\n\n* * *\n\n"), (r"(?i)<li[^>]*>", "\n- "),
    (r"(?i)</?(?:p|h[1-6]|div|ul|ol|table|tr|blockquote|article|nav|header|footer|section)(?:\s[^>]*)?>", "\n\n"),
    (r"<[^>]+>", ""),
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
]
TIDY = [
    (r"\{[^}]*\}", ""), (r"\[([^\]]*)\]\([^)]*\)", r"\1"), (r"(?m)^:::.*$", ""), (r"(?m)^[\\\s\[\]]*$", ""),
    (r"(?m) *\\$", ""), (r"\n{3,}", "\n\n"),
]
TEXT_OF = "trim(" + chain("{html}", FURNITURE + MARKUP + TIDY) + ", ' ' || chr(10) || chr(9))"


def page_text(html: str) -> str:
    return TEXT_OF.replace("{html}", html)


WRAPPED = (
    "replace(replace(html, '<p>', '<span class=\"x pagenum y\" id=\"p\">12</span><p>'), '</p>', "
    "'<sup id=\"r\" class=\"reference\">3</sup>[see](http://x.y/z) {.cls}</p><table><tr><td>n</td></tr></table>')"
)
PAGE_TEXTS = f"page_texts AS (SELECT page_id, {page_text(WRAPPED)} AS text FROM pages)"
ORACLES["clean_html"] = rf"""WITH {PAGE_TEXTS}
SELECT page_id, text, len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) AS words FROM page_texts"""

ORACLES["drop_leading_lines"] = rf"""WITH {PAGE_TEXTS},
  ls AS (SELECT page_id, string_split(text, chr(10)) AS ls FROM page_texts),
  cut AS (SELECT page_id, ls[coalesce(list_position(list_transform(ls, lambda l: regexp_matches(l, '^- [A-Z]')), true), 0) + 1 :] AS ls FROM ls),
  opened AS (SELECT page_id, ls, list_position(list_transform(ls, lambda l: trim(l) <> '' AND (starts_with(trim(l), '#')
      OR len(trim(l)) >= 70 OR regexp_matches(trim(l), '[.!?…»]$'))), true) AS k FROM cut)
SELECT page_id, CASE WHEN k > 0 THEN trim(array_to_string(ls[k:], chr(10)), ' ' || chr(10)) ELSE '' END AS text FROM opened"""

ORACLES["import_pages"] = rf"""WITH
  plan AS (SELECT doc_id AS doc, CASE WHEN doc_id % 11 = 0 THEN '' ELSE 'Pé_' || doc_id END AS title FROM labels WHERE quality = 1),
  txt AS (SELECT floor(page_id / 3 * 2)::BIGINT AS doc, page_id AS pos, {page_text('html')} AS text FROM pages),
  grp AS (SELECT doc, string_agg(text, chr(10) || chr(10) || '* * *' || chr(10) || chr(10) ORDER BY pos) AS body, count(*) AS pages,
      sum(len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')))::BIGINT AS word_count FROM txt GROUP BY doc),
  held AS (SELECT doc_id AS doc, n_chars AS old FROM documents WHERE lang <> 'es'),
  st AS (SELECT p.doc, title, body, word_count, old, CASE WHEN title = '' THEN 'skip' WHEN h.doc IS NULL OR word_count IS NULL THEN 'error'
      WHEN pages = 1 AND old > 1000 AND word_count < old * 0.3::DOUBLE THEN 'skip' ELSE 'ok' END AS status, h.doc IS NULL AS absent
    FROM plan p LEFT JOIN grp g USING (doc) LEFT JOIN held h ON h.doc = p.doc)
SELECT doc, 0::BIGINT AS segment, CASE WHEN status = 'ok' THEN body END AS body, word_count, status,
  CASE WHEN title = '' THEN 'no URL' WHEN absent THEN 'no existing document' WHEN word_count IS NULL THEN 'no stored page'
    WHEN status = 'skip' THEN 'size guard: new=' || word_count || 'w vs existing=' || old || 'w (<30%)' ELSE 'wrote ' || word_count || 'w' END AS message,
  CASE WHEN status = 'ok' THEN 'Wikisource (' || title || ', status=validated); pulled 2026-01-01' END AS provenance FROM st"""

# --- segmentation -----------------------------------------------------------------------------

WORDS = r"len(regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+'))"
ORACLES["split_at_anchor"] = f"""WITH
  r AS (SELECT doc_id AS doc, string_split(text, chr(10)) AS ls, quality, toxic FROM documents JOIN labels USING (doc_id)),
  a AS (SELECT *, CASE WHEN toxic = 1 THEN 'no such anchor' ELSE array_to_string(string_split(ls[len(ls) // 2 + 1], ' ')[1:3], ' ') END AS anchor FROM r),
  h AS (SELECT *, list_position(list_transform(ls, lambda l: contains(l, anchor)), true) AS k FROM a),
  c AS (SELECT *, CASE WHEN quality = 1 THEN k - 1 ELSE k END AS cut FROM h)
SELECT doc, 'one' AS part, array_to_string(ls[1:cut], chr(10) || chr(10)) AS body,
  {WORDS.format("array_to_string(ls[1:cut], ' ')")} AS words FROM c WHERE k > 0
UNION ALL SELECT doc, 'two', array_to_string(ls[cut + 1:], chr(10) || chr(10)), {WORDS.format("array_to_string(ls[cut + 1:], ' ')")} FROM c WHERE k > 0
UNION ALL SELECT doc, NULL, NULL, NULL FROM c WHERE k IS NULL OR k = 0"""

ORACLES["chunk_words"] = r"""WITH RECURSIVE
  p AS (SELECT doc_id AS doc, unnest(string_split(trim(text, ' ' || chr(10)), chr(10))) AS para,
      generate_subscripts(string_split(trim(text, ' ' || chr(10)), chr(10)), 1) AS i FROM documents),
  w AS (SELECT *, len(list_filter(regexp_split_to_array(para, '\s+'), lambda t: t <> '')) AS n FROM p),
  f AS (SELECT doc, i, 0 AS idx, n AS filled FROM w WHERE i = 1
    UNION ALL SELECT w.doc, w.i, CASE WHEN f.filled + w.n > 60 THEN f.idx + 1 ELSE f.idx END,
      CASE WHEN f.filled + w.n > 60 THEN w.n ELSE f.filled + w.n END FROM f JOIN w ON w.doc = f.doc AND w.i = f.i + 1)
SELECT f.doc, f.idx::BIGINT AS idx, max(f.idx + 1) OVER (PARTITION BY f.doc)::BIGINT AS total, sum(n)::BIGINT AS words,
  string_agg(para, chr(10) || chr(10) ORDER BY f.i) AS text FROM f JOIN w USING (doc, i) GROUP BY f.doc, f.idx"""

ORACLES["chunk_rows"] = r"""WITH RECURSIVE
  p AS (SELECT coalesce(lang, 'und') AS doc, doc_id, unnest(string_split(text, chr(10))) AS para,
      generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents),
  w AS (SELECT *, len(list_filter(regexp_split_to_array(para, '\s+'), lambda t: t <> '')) AS n FROM p WHERE regexp_matches(para, '\S')),
  s AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY doc_id, line, para) AS i,
      sum(n) OVER (PARTITION BY doc ORDER BY doc_id, line, para ROWS UNBOUNDED PRECEDING) AS upto FROM w),
  x AS MATERIALIZED (SELECT a.doc, a.i, greatest(b.i, a.i + 1) AS following FROM s a ASOF JOIN s b ON a.doc = b.doc AND a.upto - a.n + 2500 < b.upto),
  f AS (SELECT DISTINCT doc, 1::BIGINT AS i, 0 AS idx FROM s
    UNION ALL SELECT f.doc, x.following, f.idx + 1 FROM f JOIN x ON x.doc = f.doc AND x.i = f.i
      WHERE x.following <= (SELECT max(i) FROM s WHERE s.doc = f.doc)),
  c AS (SELECT s.doc, s.n, s.para, s.i, f.idx FROM s ASOF JOIN f ON s.doc = f.doc AND s.i >= f.i)
SELECT doc, idx::BIGINT AS idx, (max(idx) OVER (PARTITION BY doc) + 1)::BIGINT AS total, sum(n)::BIGINT AS words,
  string_agg(para, chr(10) || chr(10) ORDER BY i) AS text FROM c GROUP BY doc, idx"""
ORACLES["missing_chunks"] = r"""SELECT DISTINCT conv_id AS doc, turn::BIGINT AS idx FROM conversations m WHERE NOT EXISTS (
  SELECT 1 FROM conversations c WHERE c.conv_id = m.conv_id AND c.turn = m.turn AND c.role <> 'system' AND regexp_matches(c.text, '\S'))"""
ORACLES["reassemble_long"] = """WITH p AS (SELECT l_returnflag || '-' || l_linestatus AS doc, l_orderkey * 8 + l_linenumber AS idx, max(l_partkey)::VARCHAR AS t
    FROM lineitem GROUP BY ALL),
  b AS (SELECT doc, string_agg(t, chr(10) || chr(10) ORDER BY idx) AS body FROM p GROUP BY doc)
SELECT doc, 0::BIGINT AS segment, md5(body) AS body_md5, length(body)::BIGINT AS body_chars, 0::BIGINT AS missing FROM b"""
ORACLES["first_contained"] = """WITH d AS (SELECT doc_id, lang, string_split(text, chr(10))[1] AS line FROM documents),
  r AS (SELECT lang, array_to_string(string_split(line, ' ')[1:2], ' ') AS head, min(doc_id % 1000) AS ord FROM d GROUP BY ALL),
  n AS (SELECT lang, CASE WHEN ord = 999 THEN '' ELSE head END AS opening, ord FROM r)
SELECT doc_id, arg_min(opening, (n.ord, opening)) AS opening, min(n.ord) AS ord FROM d LEFT JOIN n ON n.lang = d.lang AND contains(line, opening) GROUP BY doc_id"""
ORACLES["opening_anywhere"] = """WITH d AS (SELECT doc_id, lang, CASE WHEN doc_id % 2 = 0 THEN 'Unless said otherwise. ' ELSE '' END || text AS body FROM documents),
  r AS (SELECT lang, array_to_string(string_split(body, ' ')[1:3], ' ') AS opening, min(doc_id) AS least FROM d WHERE body IS NOT NULL GROUP BY ALL),
  n AS (SELECT lang, opening, CASE WHEN opening = 'Unless said otherwise.' THEN 1099511627776 ELSE least END AS ord FROM r)
SELECT doc_id, arg_min(opening, (n.ord, opening)) AS opening, min(n.ord)::BIGINT AS ord FROM d LEFT JOIN n ON n.lang = d.lang AND contains(body, opening) GROUP BY doc_id"""
ORACLES["reassemble"] = """SELECT conv_id AS doc, 0::BIGINT AS segment, string_agg(CASE WHEN role = 'system'
    THEN '[[MISSING CHUNK ' || turn || ']]' ELSE trim(text, ' ' || chr(10)) END, chr(10) || chr(10) ORDER BY turn) AS body,
  count(*) FILTER (role = 'system') AS missing FROM conversations GROUP BY conv_id"""

ORACLES["seam_join"] = r"""WITH p AS (SELECT conv_id, turn, list_filter(list_transform(
      string_split(replace(replace(text, 'tion ', 'tion-|'), ', ', '| '), '|'), lambda x: trim(x)), lambda x: true) AS ps FROM conversations)
SELECT conv_id, turn, list_reduce(ps, lambda acc, x: CASE WHEN acc = '' THEN x
    WHEN regexp_matches(acc, '\p{L}-$') AND regexp_matches(x, '^\p{Ll}') THEN acc[1:len(acc) - 1] || x
    WHEN NOT regexp_matches(acc, '[.!?…»:;]$') AND regexp_matches(x, '^\p{Ll}') THEN acc || ' ' || x
    ELSE acc || chr(10) || chr(10) || x END) AS body FROM p"""

KEEP_SLUG = (
    r"regexp_replace(regexp_replace(trim(regexp_replace(translate(lower({0}), '‘’“”', ''), "
    r"'[^\p{{L}}\p{{N}}_\s-]', ' ', 'g')), '\s+', '-', 'g'), '-+', '-', 'g')"
)
FIRST2 = "array_to_string(string_split(l, ' ')[1:2], ' ')"
ORACLES["route_sections"] = rf"""WITH
  d AS (SELECT doc_id AS cahier, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '\S')) AS ls FROM documents),
  s AS (SELECT cahier, ls, (len(ls) + 1) // 2 AS n, list_transform(ls, lambda l: {KEEP_SLUG.format(FIRST2)}) AS slugs,
      list_transform(ls, lambda l: '## ' || trim({FIRST2}) || chr(10) || chr(10) || trim(l)) AS secs FROM d WHERE len(ls) > 0),
  p AS (SELECT *, list_transform(range(0, n), lambda k: slugs[2 * k + 1]) AS ps FROM s),
  m AS (SELECT *, list_transform(slugs, lambda g: coalesce(list_position(list_transform(ps, lambda q: contains(q, g) OR contains(g, q)), true), 0)) AS ats FROM p),
  x AS (SELECT cahier, n, ps, secs, ats, unnest(range(0, n)) AS pos FROM m),
  y AS (SELECT *, list_transform(list_filter(range(1, len(secs) + 1), lambda k: ats[k] = pos + 1), lambda k: secs[k]) AS mine,
      CASE WHEN pos = n - 1 THEN list_transform(list_filter(range(1, len(secs) + 1), lambda k: ats[k] = 0), lambda k: secs[k]) ELSE [] END AS rest FROM x)
SELECT cahier, pos, ps[pos + 1] AS piece_slug,
  CASE WHEN n = 1 THEN array_to_string(secs, chr(10) || chr(10)) ELSE array_to_string(list_concat(mine, rest), chr(10) || chr(10)) END AS body,
  CASE WHEN n = 1 THEN 'single' WHEN len(mine) > 0 THEN 'slug' ELSE 'rest' END AS matched_by
FROM y WHERE n = 1 OR len(mine) > 0 OR len(rest) > 0"""

NORM = r"trim(regexp_replace(lower(strip_accents({0})), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"
ORACLES["segment_by_anchor"] = rf"""WITH
  d AS (SELECT doc_id AS cahier, text, string_split(text, chr(10)) AS ls FROM documents),
  o AS (SELECT cahier, text, (len(ls) + 2) // 3 AS n, list_transform(range(0, (len(ls) + 2) // 3),
      lambda k: replace(replace(ls[3 * k + 1], 'é', 'e'), '.', ' ;')) AS ops FROM d),
  hd AS (SELECT *, array_to_string(list_transform(range(0, n), lambda k: '## Part ' || lpad(k::VARCHAR, 4, '0') || chr(10) ||
      '*by someone*' || chr(10) || chr(10) || ops[k + 1]), chr(10)) AS headed,
      regexp_replace(lower(strip_accents(text)), '[^\p{{L}}\p{{N}}_]', ' ', 'g') AS flat, {NORM.format('text')} AS norm FROM o),
  pc AS (SELECT cahier, text, n, flat, norm, headed, unnest(range(0, n)) AS pos FROM hd),
  tl AS (SELECT *, ltrim(headed[strpos(headed, '## Part ' || lpad(pos::VARCHAR, 4, '0')) + 13 + 14 :], ' ' || chr(10)) AS tail FROM pc),
  raw AS (SELECT * EXCLUDE (headed), {NORM.format('tail[1:120]')} AS a, tail = '' AS no_anchor FROM tl),
  pr AS (SELECT *, CASE WHEN len(a) < 40 THEN [{{'at': 0, 'w': a}}]
      ELSE list_transform(range(0, len(a) - 39, 20), lambda k: {{'at': k::INT, 'w': a[k + 1 : k + 40]}}) END AS probes FROM raw),
  ht AS (SELECT *, list_filter(probes, lambda q: contains(norm, q.w))[1] AS hit FROM pr),
  og AS (SELECT *, CASE WHEN hit IS NOT NULL THEN greatest(strpos(flat,
      ltrim(regexp_extract(flat, CASE WHEN hit.w[1] = ' ' THEN '[^ ]' ELSE '' END || replace(hit.w, ' ', ' +'))))
      - 1 - least(hit.at, 50), 0) END AS off0, regexp_extract(flat, CASE WHEN hit.w[1] = ' ' THEN '[^ ]' ELSE '' END || replace(hit.w, ' ', ' +')) AS m FROM ht),
  og2 AS (SELECT *, CASE WHEN hit IS NOT NULL THEN greatest(strpos(flat, m) - 1
      + CASE WHEN hit.w[1] = ' ' THEN 1 ELSE 0 END - least(hit.at, 50), 0) END AS off FROM og),
  ord AS (SELECT *, coalesce(bool_or(off < prev) OVER (PARTITION BY cahier), false) AS bad FROM
      (SELECT *, max(off) OVER (PARTITION BY cahier ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM og2)),
  fin AS (SELECT *, CASE WHEN NOT bad THEN off END AS start, CASE WHEN NOT bad AND off IS NOT NULL THEN
      coalesce(min(off) OVER (PARTITION BY cahier ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), len(text)) END AS stop FROM ord)
SELECT cahier, pos, 'p' || pos AS piece_slug, start::BIGINT AS start, stop::BIGINT AS "end",
  CASE WHEN start IS NOT NULL THEN trim(text[start + 1 : stop], ' ' || chr(10)) || chr(10) END AS body,
  CASE WHEN bad THEN 'offsets out of order' WHEN no_anchor THEN 'anchor missing' WHEN off IS NULL THEN 'anchor not found' END AS warning FROM fin"""

NESTED_PAGE = f"""replace({WRAPPED}, '</p>', '</p><div class="noprint"><div>in<br>side<p class="pagenum">x</p></div><img src="y"/> z</div><p>5 &lt; 6 a > b &eacute;t&eacute; &oelig;uvre</p>')"""
NESTED_TEXT = "trim(" + chain("html", [("&eacute;", "é"), ("&oelig;", "œ")] + MARKUP + TIDY) + ", ' ' || chr(10) || chr(9))"
# depth follows from tag to tag: a recursive step per token
ORACLES["clean_html_nested"] = rf"""WITH RECURSIVE
  k AS MATERIALIZED (SELECT page_id, regexp_extract_all({NESTED_PAGE},
    '(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>|<[!/?a-z][^>]*>|[^<]+|<') AS ks FROM pages),
  t AS MATERIALIZED (SELECT page_id, i, ks[i] AS x, lower(regexp_extract(ks[i], '^</?([A-Za-z][A-Za-z0-9]*)', 1)) AS name,
    string_split(regexp_extract(ks[i], '\sclass="([^"]*)"', 1), ' ') AS cls FROM (SELECT *, unnest(range(1, len(ks) + 1)) AS i FROM k)),
  g AS MATERIALIZED (SELECT *, name <> '' AND name NOT IN ('br', 'img', 'hr', 'meta', 'link', 'input', 'script', 'style') AND NOT ends_with(x, '/>') AS lev,
    starts_with(x, '</') AS fin, len(list_intersect(cls, ['noprint', 'pagenum', 'reference'])) > 0 AS bad FROM t),
  w(page_id, i, depth, out) AS (SELECT page_id, 0::BIGINT, 0, false FROM k UNION ALL
    SELECT w.page_id, g.i, CASE WHEN depth > 0 THEN depth + CASE WHEN lev AND NOT fin THEN 1 WHEN lev AND fin THEN -1 ELSE 0 END
      WHEN bad AND lev AND NOT fin THEN 1 ELSE 0 END, depth > 0 OR (bad AND NOT fin)
    FROM w JOIN g ON g.page_id = w.page_id AND g.i = w.i + 1),
  s AS (SELECT g.page_id, string_agg(CASE WHEN x = '<' THEN '&lt;' WHEN NOT starts_with(x, '<') THEN x
      WHEN name IN ('p', 'h1', 'h2', 'h3', 'h4', 'blockquote', 'em', 'i', 'strong', 'b', 'br', 'hr', 'ul', 'ol', 'li') THEN x ELSE '' END, '' ORDER BY g.i) AS html
    FROM g JOIN w ON w.page_id = g.page_id AND w.i = g.i WHERE NOT w.out GROUP BY g.page_id),
  o AS (SELECT page_id, {NESTED_TEXT} AS text FROM s)
SELECT k.page_id, coalesce(text, '') AS text, len(regexp_extract_all(coalesce(text, ''), '[\p{{L}}\p{{N}}_]+')) AS words FROM k LEFT JOIN o USING (page_id)"""

SLUG2 = slug(FIRST2)
LAST2 = slug("array_to_string(string_split(ls[2 * k + 1], ' ')[-2:], ' ')")
ORACLES["route_sections_one_to_one"] = rf"""WITH RECURSIVE
  d AS (SELECT doc_id AS cahier, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '\S')) AS ls FROM documents),
  s AS (SELECT cahier, ls, (len(ls) + 1) // 2 AS n, list_transform(ls, lambda l: {SLUG2}) AS slugs,
      list_transform(ls, lambda l: {FIRST2}) AS heads FROM d WHERE len(ls) > 0),
  p AS (SELECT *, list_transform(range(0, n), lambda k: {KEEP_SLUG.format('heads[2 * k + 1]')}) AS ids,
      list_transform(range(0, n), lambda k: CASE WHEN k % 3 = 0 THEN {LAST2} ELSE slugs[2 * k + 1] END) AS want FROM s),
  w AS (SELECT cahier, 0 AS i, list_transform(range(0, n), lambda k: -1) AS got FROM p
    UNION ALL SELECT w.cahier, w.i + 1, list_transform(range(0, p.n), lambda k: CASE WHEN k + 1 = coalesce(list_position(list_transform(
        range(0, p.n), lambda j: w.got[j + 1] < 0 AND (starts_with(p.slugs[w.i + 1], p.want[j + 1]) OR starts_with(p.want[j + 1], p.slugs[w.i + 1]))), true), 0)
        THEN w.i ELSE w.got[k + 1] END)
      FROM w JOIN p USING (cahier) WHERE w.i < len(p.ls)),
  f AS (SELECT p.*, w.got, list_filter(range(0, len(ls)), lambda k: NOT list_contains(w.got, k)) AS rest,
      list_filter(range(0, n), lambda k: w.got[k + 1] < 0) AS open FROM w JOIN p USING (cahier) WHERE w.i = len(p.ls)),
  x AS (SELECT *, unnest(range(0, n)) AS pos FROM f),
  y AS (SELECT *, got[pos + 1] AS g, rest[list_position(open, pos)] AS fill FROM x)
SELECT cahier, pos, ids[pos + 1] AS piece_slug,
  CASE WHEN n = 1 THEN array_to_string(list_transform(range(1, len(ls) + 1), lambda k: '## ' || heads[k] || chr(10) || ls[k]), chr(10))
    ELSE CASE WHEN g >= 0 THEN trim(ls[g + 1]) WHEN fill IS NOT NULL THEN '## ' || trim(heads[fill + 1]) || chr(10) || trim(ls[fill + 1]) ELSE '' END
      || CASE WHEN pos = n - 1 AND len(rest) > len(open) THEN chr(10) || chr(10) || array_to_string(list_transform(rest[len(open) + 1:],
        lambda k: '## ' || trim(heads[k + 1]) || chr(10) || ls[k + 1] || CASE WHEN k = len(ls) - 1 THEN '' ELSE chr(10) END), chr(10) || chr(10)) ELSE '' END END AS body,
  CASE WHEN n = 1 THEN 'single' WHEN g >= 0 THEN 'slug' WHEN fill IS NOT NULL THEN 'order' END AS matched_by FROM y"""

ORACLES["route_section_rows"] = ORACLES["route_sections_one_to_one"].split("\nSELECT cahier, pos")[0] + """,
  r AS (SELECT cahier, pos, ids[pos + 1] AS piece_slug, 0::BIGINT AS seq, CASE WHEN g >= 0 THEN g ELSE fill END AS sec,
      CASE WHEN g >= 0 THEN 'slug' WHEN fill IS NOT NULL THEN 'order' END AS matched_by FROM y WHERE n > 1
    UNION ALL SELECT cahier, n - 1, ids[n], unnest(range(1, len(rest) - len(open) + 1)), unnest(rest[len(open) + 1:]), 'rest'
      FROM f WHERE n > 1 AND len(rest) > len(open)
    UNION ALL SELECT cahier, 0, ids[1], unnest(range(0, len(ls))), unnest(range(0, len(ls))), 'single' FROM f WHERE n = 1)
SELECT r.cahier, pos::BIGINT AS pos, piece_slug, CASE WHEN sec IS NOT NULL THEN seq END AS seq, sec::BIGINT AS sec,
  heads[sec + 1] AS head, ls[sec + 1] AS body, matched_by FROM r JOIN s USING (cahier)"""

# --- sources and sinks --------------------------------------------------------------------------

FIRST3 = "array_to_string(string_split(string_split(text, chr(10))[1], ' ')[1:3], ' ')"
ORACLES["file_keys"] = f"""WITH n AS (SELECT doc_id, lang, 's' || lpad((doc_id % 15 + 1)::VARCHAR, 2, '0') || '-c' ||
    CASE WHEN doc_id % 120 < 100 THEN lpad((doc_id % 120)::VARCHAR, 2, '0') ELSE (doc_id % 120)::VARCHAR END AS cahier,
    {slug(FIRST3)} AS piece_slug, lang IN ('fr', 'en') AND doc_id % 120 < 100 AS good FROM documents)
SELECT doc_id, cahier || '--' || piece_slug || '.' || lang || '.md' AS name, CASE WHEN good THEN cahier END AS cahier,
  CASE WHEN good THEN piece_slug END AS piece_slug, CASE WHEN good THEN lang END AS lang FROM n"""

HEAD_LINES = """'--' || chr(10) || 'cahier: k' || c_custkey || chr(10) || 'title: first' || chr(10) || 'pieceSlug:   ''' || c_name || '''' || chr(10)
      || 'author: "n: ' || c_nationkey || '"' || chr(10) || 'word count: 3' || chr(10) || 'no value here' || chr(10) || 'title: "' || c_mktsegment
      || '"' || chr(10) || 'wordCount: ' || CASE WHEN c_acctbal < 0 THEN 'many' ELSE floor(c_acctbal)::BIGINT::VARCHAR END || chr(10) || '---' || chr(10)"""
BODY_LINES = "chr(10) || 'Body of ' || c_name || chr(10) || '---' || chr(10) || 'end' || chr(10)"
ORACLES["parse_headers"] = f"""SELECT c_custkey,
  CASE WHEN h THEN c_name END AS word_slug, CASE WHEN h THEN c_mktsegment END AS word_title,
  CASE WHEN h THEN 'n: ' || c_nationkey END AS word_author, NULL::VARCHAR AS word_count,
  CASE WHEN h THEN c_name END AS colon_slug, CASE WHEN h THEN c_mktsegment END AS colon_title,
  CASE WHEN h THEN 'n: ' || c_nationkey END AS colon_author, CASE WHEN h THEN '3' END AS colon_count,
  CASE WHEN h THEN '''' || c_name || '''' END AS raw_slug, CASE WHEN h THEN '"' || c_mktsegment || '"' END AS raw_title,
  CASE WHEN h THEN '"n: ' || c_nationkey || '"' END AS raw_author, CASE WHEN h THEN '3' END AS raw_count,
  CASE WHEN h AND c_acctbal >= 0 THEN floor(c_acctbal)::BIGINT END AS wc,
  CASE WHEN h THEN '' ELSE {HEAD_LINES} END || {BODY_LINES} AS body
FROM (SELECT *, c_nationkey <> 0 AS h FROM customer)"""

ORACLES["validate_rows"] = """SELECT c_custkey, array_to_string(list_filter([
    CASE WHEN NOT c_nationkey BETWEEN 1 AND 15 THEN 'series' END, CASE WHEN floor(c_acctbal / 100) < 1 THEN 'issue' END,
    CASE WHEN c_nationkey = 3 THEN 'title_fr' END, CASE WHEN c_nationkey = 4 THEN 'source_url' END,
    CASE WHEN c_nationkey IN (6, 7) THEN 'pieces' END], lambda v: v IS NOT NULL), '|') AS violations FROM customer"""

ORACLES["render_documents"] = rf"""SELECT source AS cahier, 'd' || doc_id AS piece_slug, lang,
  '---' || chr(10) || 'cahier: ' || source || chr(10) || 'pieceSlug: d' || doc_id || chr(10) || 'lang: ' || lang || chr(10) || 'title: ' ||
  CASE WHEN doc_id % 5 = 0 THEN '"a \"b\": ' || source || '"'
       WHEN regexp_matches({FIRST3}, '[:#''"]') THEN '"' || replace({FIRST3}, '"', '\"') || '"' ELSE {FIRST3} END
  || chr(10) || 'author: ' || source || chr(10) || 'isAvertissement: ' || (doc_id % 2 = 0) || chr(10) || 'wordCount: ' ||
  len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) || chr(10)
  || CASE WHEN doc_id % 2 = 1 THEN 'sourceProvenance: given' || chr(10) ELSE '' END || CASE WHEN doc_id % 4 = 0 THEN 'ocrSource: scan' || chr(10) ELSE '' END
  || CASE WHEN doc_id % 3 = 0 THEN 'introducesPiece: d' || doc_id || chr(10) ELSE '' END || 'translationDate: 2026-01-01' || chr(10)
  || CASE WHEN doc_id % 7 = 0 THEN 'translationNotes: "see: notes"' || chr(10) ELSE '' END || '---' || chr(10) || chr(10) || rtrim(text, ' ' || chr(10)) || chr(10) AS text
FROM documents"""

ORACLES["catalog_records"] = r"""SELECT p_size AS series, p_partkey::INT AS issue, p_brand AS label, 'https://e.org/' || p_partkey AS url,
  'L''' || p_name || ' d''' || p_type || '. (\)' AS description FROM part"""

CAPS = "array_to_string(list_transform(string_split(replace(p_name, ' ', ' et '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
KIND = "upper(p_type[1]) || lower(p_type[2:])"
ORACLES["description_pieces"] = f"""WITH p AS (SELECT p_partkey, p_name, p_type, p_size % 3 = 0 AS lead, p_size % 4 > 0 AS one, p_size % 5 > 0 AS two FROM part),
  t AS (SELECT p_partkey, list_filter(CASE
      WHEN one THEN [CASE WHEN lead THEN {{'t': {KIND} || ' lead', 'a': ''}} END, {{'t': 'First ' || p_name, 'a': {CAPS}}}, {{'t': 'Second', 'a': {CAPS}}},
        CASE WHEN two THEN {{'t': 'Third title', 'a': {KIND}}} ELSE {{'t': 'end', 'a': {CAPS}}} END]
      WHEN two THEN [{{'t': CASE WHEN lead THEN {KIND} || ' lead. ' ELSE '' END || 'Plain', 'a': ''}}, {{'t': 'Third title', 'a': {KIND}}}]
      ELSE [{{'t': CASE WHEN lead THEN {KIND} || ' lead. ' ELSE '' END || 'Plain end', 'a': ''}}] END, lambda x: x IS NOT NULL) AS ts FROM p),
  u AS (SELECT p_partkey, (generate_subscripts(ts, 1) - 1)::BIGINT AS pos, unnest(ts) AS z FROM t)
SELECT p_partkey, pos, z.t AS title, z.a AS author FROM u"""

ORDINALS = quoted((
    "Premier Deuxième Troisième Quatrième Cinquième Sixième Septième Huitième Neuvième Dixième Onzième Douzième Treizième "
    "Quatorzième Quinzième Seizième Dix-septième Dix-huitième Dix-neuvième Vingtième Vingt-et-unième Vingt-deuxième Vingt-troisième"
).split())
ORACLES["name_fields"] = f"""WITH c AS (SELECT *, c_custkey % 30 AS issue, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS first,
    replace(c_name, '#', '-') AS last, (c_custkey % 900 + 1000)::VARCHAR AS y, [{ORDINALS}] AS o,
    ['I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX', 'X', 'XI', 'XII', 'XIII', 'XIV', 'XV'] AS r FROM customer)
SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN first || ' et Jean ' || last ELSE last || ', ' || first END AS sort_name,
  y AS born, CASE WHEN c_nationkey % 2 = 0 THEN (c_nationkey || y)[1:4] END AS died,
  's' || lpad(c_nationkey::VARCHAR, 2, '0') || '-c' || lpad(issue::VARCHAR, 2, '0') AS issue_key,
  coalesce(CASE WHEN issue > 0 THEN o[issue] END, issue::VARCHAR) || ' cahier de la ' ||
    lower(coalesce(CASE WHEN c_nationkey > 0 THEN o[c_nationkey] END, c_nationkey::VARCHAR)) || ' série' AS issue_title,
  coalesce(CASE WHEN c_nationkey > 0 THEN r[c_nationkey] END, c_nationkey::VARCHAR) AS roman, false AS is_notice FROM c"""

ORACLES["find_piece"] = """WITH w AS (SELECT s_suppkey AS id, 'Brand#' || (s_suppkey % 25 + 1) AS cahier,
    CASE WHEN s_nationkey < 8 THEN ['red', 'plate'] WHEN s_nationkey < 16 THEN ['ge'] ELSE ['nothing'] END AS ks FROM supplier),
  m AS (SELECT id, cahier, p_partkey, (CASE WHEN contains(p_name, ks[1]) AND contains(p_name, ks[len(ks)]) THEN 0 ELSE 1 END) AS miss
    FROM w JOIN part ON p_brand = cahier),
  n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY miss, p_partkey) AS k FROM m)
SELECT id, cahier, 'p' || p_partkey AS piece_slug FROM n WHERE k = 1"""

ORACLES["insert_absent"] = """SELECT doc_id, coalesce(quality, -1)::INT AS quality FROM documents LEFT JOIN labels USING (doc_id)"""

ORACLES["good_leaves"] = "SELECT l_orderkey AS id, l_linenumber AS leaf FROM lineitem WHERE l_returnflag <> 'R'"

ORACLES["import_totals"] = f"SELECT status, count(*) AS n FROM ({ORACLES['import_pages']}) GROUP BY status"

# Parts give every issue three titles; the text's own heading matches none of them, "Avis" matches the second.
ORACLES["load_catalog"] = rf"""WITH
  t AS (SELECT conv_id * 10 + turn // 2 AS k, CASE WHEN turn % 2 = 0 THEN 'fr' ELSE 'en' END AS lang, role, text FROM conversations),
  names AS (SELECT p_name, min(p_partkey) AS at_key FROM part GROUP BY p_name),
  -- a name takes the slug of the first name it contains or is contained in ("old et rod" in "cold et rod")
  near AS (SELECT a.p_name, arg_min(b.p_name, b.at_key) AS near FROM names a JOIN names b ON b.at_key <= a.at_key
    AND (contains(a.p_name, b.p_name) OR contains(b.p_name, a.p_name)) AND abs(len(a.p_name) - len(b.p_name)) <= 3 GROUP BY a.p_name),
  j AS (SELECT 's' || CASE WHEN k // 50 + 1 < 10 THEN '0' ELSE '' END || (k // 50 + 1) || '-c' || lpad((k % 50)::VARCHAR, 2, '0') AS cahier,
      lang, role, text, {KIND} AS kind, CASE WHEN near = 'red plate' THEN 's-1' ELSE replace(near, ' ', '-et-') END AS author
    FROM t JOIN part ON p_partkey = k JOIN near USING (p_name)),
  u AS (SELECT cahier, lang, author, slug, title, body FROM (
    SELECT *, 'title-' || lower(kind) AS slug, 'Title ' || kind AS title, '## Title ' || role || chr(10) || trim(text, ' ' || chr(10)) AS body FROM j
    UNION ALL SELECT *, 'avis', 'Avis', 'Short.' FROM j
    UNION ALL SELECT *, 'title-' || lower(kind) || '-2', 'Title ' || kind, '' FROM j))
SELECT cahier, slug AS piece_slug, lang, title, author, slug = 'avis' AS is_notice,
  len(list_filter(regexp_split_to_array(body, '\s+'), lambda w: w <> ''))::BIGINT AS word_count, body FROM u"""

"""The registered queries in SQL that DuckDB runs on the same tables."""

from __future__ import annotations

SPACE = r"\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
SPECIAL = "/.,-—–:;()[]*%₹«»“”|"
METRIC_SPECIAL = "/.,-—–:;()[]{}*%₹«»“”|"
LETTERS = "À-ÖØ-öø-ÿ"
PAIR = rf"[0-9]{{1,4}}[{SPACE}]*[./\-–—:][{SPACE}]*[0-9A-Za-z{LETTERS}]{{1,8}}"
CHAIN = rf"[0-9]+(?:[{SPACE}]*[./\-–—][{SPACE}]*[0-9A-Za-z{LETTERS}]+){{2,}}"


def strip(t: str) -> str:
    return f"regexp_replace({t}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def count(t: str, alphabet: str) -> str:
    return f"CAST(length({t}) - length(translate({t}, '{alphabet}', '')) AS INTEGER)"


def round_py(x: str, digits: int = 4) -> str:
    """Rounding of the exact binary value, ties to even, as in the engine."""
    s = f"{10**digits}.0::DOUBLE"
    high = f"(({x}) * 134217729.0::DOUBLE - (({x}) * 134217729.0::DOUBLE - ({x})))"
    p = f"(({x}) * {s})"
    err = f"(({high} * {s} - {p}) + (({x}) - {high}) * {s})"
    beyond = f"(({p} - floor({p}) - 0.5::DOUBLE) + {err})"
    return f"((floor({p}) + CASE WHEN {beyond} > 0 OR ({beyond} = 0 AND floor({p}) % 2 <> 0) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) / {s})"


LINES = f"""raw AS (
  SELECT doc_id, source AS source_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents WHERE text IS NOT NULL),
lines AS (SELECT * FROM (
  SELECT doc_id, source_id, CAST(line_no AS INTEGER) AS line_no, doc_id * 1000000000 + line_no AS seq,
         translate(regexp_replace({strip('line')}, '[{SPACE}]+', ' ', 'g'), chr(8205) || chr(8204), '') AS text
  FROM raw) WHERE text <> '')"""

WORDS = f"CAST(len(list_filter(regexp_split_to_array(text, '[{SPACE}]+'), lambda w: w <> '')) AS INTEGER)"

FEATURES = f"""feat AS (
  SELECT *, {count('text', '0123456789')} AS native_digit_count, 0 AS ascii_digit_count, {count('text', '/')} AS slash_count,
    {count('text', '.')} AS period_count, {count('text', ',')} AS comma_count, {count('text', '-')} AS hyphen_count,
    {count('text', '—–')} AS dash_count, {count('text', ':')} AS colon_count, {count('text', ';')} AS semicolon_count,
    {count('text', '()[]{}')} AS bracket_count, {count('text', SPECIAL)} AS symbol_count,
    CAST((length(text) - length(replace(text, '€', ''))) + (length(text) - length(replace(text, 'EUR', ''))) // 3 AS INTEGER) AS currency_count,
    {count('text', '%')} AS percent_count, {count('text', '्')} AS conjunct_estimate, 0.0::DOUBLE AS matra_score,
    CAST(length(text) AS INTEGER) AS text_length, CAST(length({strip('text')}) AS INTEGER) AS char_count, {WORDS} AS word_count,
    (CASE WHEN regexp_matches(text, '{CHAIN}') THEN 2.0::DOUBLE WHEN regexp_matches(text, '{PAIR}') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
      + CASE WHEN {count('text', '0123456789')} >= 3 AND {count('text', '/-.:')} >= 2 THEN 0.75::DOUBLE ELSE 0.0::DOUBLE END AS identifier_likeness_score
  FROM lines),
feats AS (
  SELECT *, (native_digit_count + ascii_digit_count)::DOUBLE / greatest(text_length, 1) AS numeric_density,
    symbol_count::DOUBLE / greatest(text_length, 1) AS special_character_density, identifier_likeness_score AS reference_pattern_score,
    least(word_count::DOUBLE / 8.0::DOUBLE, 3.0::DOUBLE) + least(text_length::DOUBLE / 80.0::DOUBLE, 2.0::DOUBLE) AS dense_text_score
  FROM feat)"""


def _d(x: str) -> str:
    return f"{x}::DOUBLE"


RAW_SCORE = f"""least(native_digit_count, 12) * {_d(0.45)} + least(slash_count, 6) * {_d(0.35)} + least(period_count, 10) * {_d(0.15)}
  + least(hyphen_count + dash_count, 6) * {_d(0.25)} + least(comma_count + colon_count, 8) * {_d(0.12)} + least(bracket_count, 6) * {_d(0.2)}
  + least(currency_count + percent_count, 4) * {_d(0.5)} + least(conjunct_estimate, 15) * {_d(0.15)} + matra_score
  + identifier_likeness_score * {_d(0.8)} + dense_text_score + special_character_density * 8 + numeric_density * 8
  - ascii_digit_count * {_d(0.5)}"""

SCORED = f"""raw_scored AS (SELECT *, {RAW_SCORE} AS raw_score FROM feats),
scored AS (
  SELECT *, {round_py('raw_score')} AS score,
    (word_count > 50) AS is_too_long,
    (native_digit_count >= 2 OR (native_digit_count >= 1 AND (identifier_likeness_score > 0 OR slash_count >= 1 OR symbol_count >= 3))
      OR identifier_likeness_score >= 1.5 OR (currency_count >= 1 AND (native_digit_count >= 1 OR symbol_count >= 2))) AS is_strong,
    ({strip('text')} <> '' AND native_digit_count + ascii_digit_count + currency_count + percent_count + slash_count = 0
      AND identifier_likeness_score = 0 AND NOT regexp_matches(text, '[/₹%—–*\\[\\]]')
      AND colon_count + semicolon_count + bracket_count + hyphen_count + dash_count <= 2 AND special_character_density <= 0.06) AS is_ordinary
  FROM raw_scored),
flagged AS (
  SELECT *, (char_count < 8 OR word_count < 2 OR word_count > 50 OR (word_count <= 1 AND score < 2.5)
      OR regexp_matches({strip('text')}, '^[Tt]able of contents\\.?$')) OR is_too_long AS is_trivial FROM scored),
gated AS (
  SELECT *, (is_trivial AND NOT (native_digit_count > 0 OR identifier_likeness_score > 0)) AS weak,
    (is_ordinary AND word_count BETWEEN 6 AND 40) AS plain FROM flagged),
laned AS (
  SELECT * EXCLUDE (score), score AS first_score,
    CASE WHEN weak THEN 'reject' WHEN plain THEN 'normal' WHEN is_strong AND score >= 3.0 THEN 'hard' ELSE 'reject' END AS difficulty,
    CASE WHEN weak THEN score WHEN plain THEN least(score, 2.5::DOUBLE) ELSE score END AS complexity_score,
    CASE WHEN weak THEN 'none' WHEN plain THEN 'heuristic_ordinary' WHEN is_strong AND score >= 3.0 THEN 'heuristic_strong' ELSE 'none' END AS hard_signal_source,
    CASE WHEN weak THEN 'trivial_or_too_long' WHEN plain THEN NULL WHEN is_strong AND score >= 3.0 THEN NULL
         ELSE 'weak_complexity_awaiting_llm_or_stronger_signals' END AS reject_reason
  FROM gated)"""

LANED = f"WITH {LINES}, {FEATURES}, {SCORED}"

VERDICTS = f"""{LANED},
named AS (SELECT doc_id, quality = 1 AS exact_match,
    CASE WHEN toxic = 1 THEN 'reject' WHEN doc_id % 3 = 0 THEN 'hard' WHEN doc_id % 3 = 1 THEN 'normal' END AS lane,
    CASE WHEN doc_id % 5 <> 0 THEN doc_id % 2 = 0 END AS complex, doc_id % 7 = 0 AS skipped, 'vision' AS mode FROM labels),
joined AS (SELECT l.*, v.exact_match, coalesce(v.lane, '') AS told, v.lane, v.complex, coalesce(v.skipped, TRUE) AS skipped, v.mode
  FROM laned l LEFT JOIN named v USING (doc_id)),
ruled AS (SELECT *, NOT skipped AND told IN ('hard', 'normal', 'reject') AS used,
    CASE WHEN told = 'reject' OR weak THEN 'reject' WHEN told = 'hard' AND plain AND NOT is_strong THEN 'normal' ELSE told END AS new_lane,
    CASE WHEN told = 'reject' OR weak THEN complexity_score WHEN told = 'hard' AND plain AND NOT is_strong THEN least(complexity_score, 2.5::DOUBLE) ELSE complexity_score END AS new_score,
    CASE WHEN told <> 'reject' AND NOT weak AND told = 'hard' AND plain AND NOT is_strong THEN 'llm_demoted_ordinary' ELSE 'llm' END AS new_source,
    CASE WHEN told = 'reject' THEN 'llm_complexity_reject' WHEN weak THEN 'trivial_or_too_long' END AS new_reason,
    difficulty = 'hard' AND hard_signal_source <> 'llm' AS open_hard FROM joined)"""

RELABELLED = f"""{VERDICTS},
merged AS (SELECT seq, doc_id, source_id, text, told, lane, complex, exact_match, skipped, mode, used,
    CASE WHEN used THEN new_lane WHEN skipped AND open_hard AND NOT is_strong THEN 'reject' ELSE difficulty END AS difficulty,
    CASE WHEN used THEN new_score ELSE complexity_score END AS complexity_score,
    CASE WHEN used THEN new_source WHEN skipped AND open_hard THEN CASE WHEN is_strong THEN 'heuristic_strong_soft_fail' ELSE 'demoted_soft_fail' END ELSE hard_signal_source END AS hard_signal_source,
    CASE WHEN used THEN coalesce(new_reason, reject_reason) WHEN skipped AND open_hard AND NOT is_strong THEN 'hard_unconfirmed_llm_soft_fail' ELSE reject_reason END AS reject_reason
  FROM ruled),
reviewed AS (SELECT *, CASE WHEN difficulty = 'reject' THEN 'rejected'
    WHEN (NOT skipped AND exact_match IS NOT DISTINCT FROM FALSE) OR (NOT skipped AND difficulty = 'hard' AND complex IS NOT DISTINCT FROM FALSE)
      OR (NOT skipped AND told = 'reject') THEN 'needs_llm_attention' ELSE 'pending_review' END AS review_status FROM merged)"""

LABELLED = f"""{VERDICTS},
texts AS (SELECT *, {strip("CASE WHEN seq % 4 <> 0 THEN text ELSE '' END")} AS assist,
    {strip("CASE WHEN seq % 3 <> 0 THEN replace(text, 'e', 'c') ELSE '' END")} AS ocr,
    {strip("CASE WHEN seq % 6 = 0 THEN text ELSE '' END")} AS old, mode IS NOT NULL AND NOT skipped AS ran FROM ruled),
chosen AS (SELECT *,
    CASE WHEN ran AND exact_match IS NOT DISTINCT FROM TRUE THEN CASE WHEN assist <> '' THEN assist WHEN old <> '' THEN old ELSE ocr END
         WHEN ran AND exact_match IS NOT DISTINCT FROM FALSE THEN ocr WHEN assist <> '' THEN assist WHEN ocr <> '' THEN ocr ELSE old END AS label,
    CASE WHEN ran AND exact_match IS NOT DISTINCT FROM TRUE THEN CASE WHEN assist || old || ocr <> '' THEN 'auto_vision_match' ELSE 'auto_empty' END
         WHEN ran AND exact_match IS NOT DISTINCT FROM FALSE THEN CASE WHEN ocr <> '' THEN 'auto_ocr_vision_corrected' ELSE 'auto_empty' END
         WHEN assist <> '' THEN 'auto_pdf_text' WHEN ocr <> '' THEN 'auto_ocr' WHEN old <> '' THEN 'auto_existing' ELSE 'auto_empty' END AS gt_source,
    CASE WHEN ran AND exact_match IS NOT DISTINCT FROM TRUE THEN CASE WHEN assist || old || ocr = '' THEN 'empty_after_vision_match' END
         WHEN ran AND exact_match IS NOT DISTINCT FROM FALSE THEN CASE WHEN ocr = '' THEN 'vision_mismatch_no_ocr' END
         WHEN assist || ocr || old = '' THEN 'empty_auto_label' END AS label_reason FROM texts)"""

ACCEPTED = f"""{LABELLED},
derived AS (SELECT *, CASE WHEN told = '' AND NOT skipped AND complex THEN 'hard' WHEN told = '' AND NOT skipped AND NOT complex THEN 'normal' ELSE told END AS told2 FROM chosen),
relaned AS (SELECT *, NOT skipped AND told2 IN ('hard', 'normal', 'reject') AS use2,
    CASE WHEN told2 = 'reject' OR weak THEN 'reject' WHEN told2 = 'hard' AND plain AND NOT is_strong THEN 'normal' ELSE told2 END AS lane2,
    CASE WHEN told2 = 'hard' AND plain AND NOT is_strong AND NOT weak THEN least(complexity_score, 2.5::DOUBLE) ELSE complexity_score END AS score2 FROM derived),
final AS (SELECT *, CASE WHEN use2 THEN lane2 WHEN open_hard AND NOT is_strong THEN 'reject' ELSE difficulty END AS accepted_lane,
    CASE WHEN use2 THEN score2 ELSE complexity_score END AS accepted_score FROM relaned),
reasoned AS (SELECT *, CASE WHEN label_reason IS NOT NULL THEN label_reason WHEN label = '' THEN 'empty_auto_label'
    WHEN use2 AND accepted_lane = 'reject' THEN 'llm_complexity_reject' WHEN accepted_lane = 'reject' THEN 'hard_unconfirmed_llm_soft_fail'
    WHEN accepted_lane NOT IN ('hard', 'normal') THEN 'no_lane' END AS reason FROM final),
gate AS (SELECT *, accepted_lane AS lane3 FROM reasoned WHERE reason IS NULL
    AND NOT (ran AND ((exact_match IS NOT DISTINCT FROM FALSE AND gt_source NOT IN ('auto_ocr_vision_corrected', 'auto_vision_match')) OR lane IS NOT DISTINCT FROM 'reject'))),
exported AS (SELECT * EXCLUDE (lane3), CASE WHEN ran AND lane3 = 'hard' AND complex IS NOT DISTINCT FROM FALSE THEN 'normal' ELSE lane3 END AS lane4 FROM gate),
top AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY accepted_score DESC, seq) AS n FROM exported WHERE lane4 = 'hard') WHERE n <= 80
  UNION ALL SELECT * FROM (SELECT *, row_number() OVER (ORDER BY word_count DESC, seq) AS n FROM exported WHERE lane4 = 'normal') WHERE n <= 20)"""

ISSUE = """CASE WHEN regexp_matches({t}, 'No\\.[{s}]*[0-9]|Ref[.:]') THEN 'complex_reference_number'
  WHEN regexp_matches({t}, '[0-9][^\\n]*[0-9]') AND regexp_matches({t}, '[/.]') THEN 'native_numerals'
  WHEN regexp_matches({t}, '[/₹%()\\[\\]—]') THEN 'special_chars_issue'
  WHEN contains({t}, 'date:') OR contains({t}, 'Date:') THEN 'date_issue' ELSE 'dense_document_text' END"""


def issue(t: str) -> str:
    return ISSUE.replace("{t}", t).replace("{s}", SPACE)


REGION = f"""CASE WHEN regexp_matches(text, 'No\\.[{SPACE}]*[0-9]|Ref[.:]') THEN 'reference_identifier'
  WHEN regexp_matches(text, '\\b[Dd]ate:|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'date_line' WHEN regexp_matches(text, '€|EUR|%') THEN 'financial'
  WHEN regexp_matches(text, '^[0-9]+[.)]') THEN 'numbered_section' WHEN length(text) > 80 THEN 'paragraph_section' ELSE 'text_line' END"""

_PICK = f"""{LANED},
picked AS (SELECT *, CASE WHEN difficulty = 'hard' THEN 6 ELSE 2 END AS share,
    row_number() OVER (PARTITION BY source_id, difficulty ORDER BY CASE WHEN difficulty = 'hard' THEN complexity_score ELSE word_count::DOUBLE END DESC, seq) AS lane_rank
  FROM laned WHERE difficulty IN ('hard', 'normal')),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY source_id ORDER BY CASE WHEN lane_rank <= share THEN CASE WHEN difficulty = 'hard' THEN 0 ELSE 1 END
    ELSE CASE WHEN difficulty = 'hard' THEN 2 ELSE 3 END END, lane_rank) AS INTEGER) AS pick_rank FROM picked)"""

_SELECT = f"""{LANED},
h1 AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY complexity_score DESC, native_digit_count > 0 DESC, identifier_likeness_score DESC, seq) AS n FROM laned WHERE difficulty = 'hard' AND complexity_score >= 3.0),
h2 AS (SELECT *, row_number() OVER (ORDER BY complexity_score DESC, native_digit_count > 0 DESC, identifier_likeness_score DESC, seq) AS r FROM h1 WHERE n <= 8),
hard AS (SELECT * FROM h2 WHERE r <= 80),
taken AS (SELECT source_id, count(*) AS taken FROM hard GROUP BY 1),
n0 AS (SELECT l.*, coalesce(t.taken, 0) AS taken, CASE WHEN t.taken IS NULL THEN 0 ELSE 1 END AS used FROM laned l LEFT JOIN taken t USING (source_id) WHERE difficulty = 'normal' AND is_ordinary),
n1 AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY word_count DESC, complexity_score DESC, used, seq) AS n FROM n0),
n2 AS (SELECT *, row_number() OVER (ORDER BY word_count DESC, complexity_score DESC, used, seq) AS r FROM n1 WHERE n <= 8 - taken),
sel AS (SELECT seq, source_id, difficulty, r FROM hard UNION ALL SELECT seq, source_id, difficulty, r FROM n2 WHERE r <= 20)"""

READINGS = f"""items AS (SELECT item_id, regexp_replace(text, '[^\\x20-\\x7E\\n]', '', 'g') AS ref FROM benchmark),
readings AS (
  SELECT item_id, ref, 'exact' AS backend, ref AS hyp FROM items UNION ALL
  SELECT item_id, ref, 'confused', replace(replace(ref, 'e', 'c'), '.', ',') FROM items UNION ALL
  SELECT item_id, ref, 'sparse', CASE WHEN item_id % 9 = 0 THEN '' ELSE regexp_replace(ref, '[,.]', '', 'g') END FROM items),
clean AS (SELECT *, regexp_replace({strip('ref')}, '[{SPACE}]+', ' ', 'g') AS r, regexp_replace({strip('hyp')}, '[{SPACE}]+', ' ', 'g') AS h,
    {strip('ref')} AS rs, {strip('hyp')} AS hs FROM readings)"""

_HITS = " + ".join(f"least({count('r', c)}, {count('h', c)})" for c in METRIC_SPECIAL)
_KEEP = "[^" + "".join(rf"\x{{{ord(c):X}}}" for c in METRIC_SPECIAL) + "]"

PAIRS = f"""WITH {READINGS},
parts AS (SELECT *, {count('r', METRIC_SPECIAL)} AS want, {count('h', METRIC_SPECIAL)} AS got, {_HITS} AS hits,
    regexp_replace(r, '[^0-9]', '', 'g') AS rd, regexp_replace(h, '[^0-9]', '', 'g') AS hd,
    regexp_replace(r, '{_KEEP}', '', 'g') AS rp, regexp_replace(h, '{_KEEP}', '', 'g') AS hp,
    regexp_matches(ref, '{CHAIN}') OR regexp_matches(ref, '{PAIR}') OR ({count('ref', '0123456789')} >= 3 AND {count('ref', '/-.:')} >= 2)
      OR regexp_matches(ref, 'Ref[.:]|[0-9A-Za-z.]+/[0-9A-Za-z./-]+') OR regexp_matches(ref, '[0-9]{{1,2}}[./-][0-9]{{1,2}}[./-][0-9]{{2,4}}') OR {count('ref', '/')} >= 2 AS is_reference_like
  FROM clean),
prf AS (SELECT *, CASE WHEN want = 0 AND got = 0 THEN 1.0::DOUBLE WHEN got = 0 THEN 0.0::DOUBLE ELSE hits::DOUBLE / greatest(got, 1) END AS prec,
    CASE WHEN want = 0 AND got = 0 THEN 1.0::DOUBLE WHEN want = 0 THEN 0.0::DOUBLE ELSE hits::DOUBLE / greatest(want, 1) END AS rec FROM parts),
metrics AS (SELECT item_id, backend,
    (item_id * 37 % 101 + length(backend))::DOUBLE AS latency_ms,
    CASE WHEN r = '' THEN CASE WHEN h = '' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END ELSE levenshtein(r, h)::DOUBLE / greatest(length(r), 1) END AS cer,
    CASE WHEN rs = '' THEN CASE WHEN hs = '' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END ELSE levenshtein(rs, hs)::DOUBLE / greatest(length(rs), 1) END AS cer_strict,
    r = h AS exact_match, rs = hs AS exact_match_strict,
    CASE WHEN rd = '' THEN CASE WHEN hd = '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END ELSE 1.0::DOUBLE - levenshtein(rd, hd)::DOUBLE / greatest(length(rd), 1) END AS native_numeral_accuracy,
    FALSE AS ascii_digit_contamination, regexp_matches(ref, '[0-9]') AS gt_has_native_digits, 0 AS ascii_digit_count_in_pred,
    CASE WHEN rp = '' THEN CASE WHEN hp = '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END ELSE 1.0::DOUBLE - levenshtein(rp, hp)::DOUBLE / greatest(length(rp), 1) END AS special_char_accuracy,
    prec AS special_char_precision, rec AS special_char_recall,
    CASE WHEN want = 0 AND got = 0 THEN 1.0::DOUBLE WHEN prec + rec = 0 THEN 0.0::DOUBLE ELSE 2 * prec * rec / (prec + rec) END AS special_char_f1,
    is_reference_like, CASE WHEN is_reference_like THEN CASE WHEN r = h THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS reference_id_exact,
    CAST(length(rs) AS INTEGER) AS char_count, CAST(len(list_filter(string_split(r, ' '), lambda w: w <> '')) AS INTEGER) AS word_count,
    {issue('ref')} AS issue_type, 's' || CAST(item_id % 50 AS VARCHAR) AS source_id FROM prf),
banded AS (SELECT *, cer AS cer_normalized, CASE WHEN char_count <= 25 THEN 'short_le_25' ELSE 'long_gt_25' END AS char_band,
    CASE WHEN word_count <= 1 THEN 'words_1' WHEN word_count <= 5 THEN 'words_2_5' ELSE 'words_6_plus' END AS word_band,
    CASE WHEN gt_has_native_digits THEN 'true' ELSE 'false' END AS contains_native_digits FROM metrics)"""


def _slice(name: str, label: str) -> str:
    group = "GROUP BY backend" if name == "all" else f"GROUP BY backend, {label}"
    return f"""SELECT backend, '{name}' AS slice, {label} AS label, count(*) AS n, round(avg(cer), 9) AS cer, round(avg(exact_match::INT::DOUBLE), 9) AS exact_match,
      round(avg(special_char_f1), 9) AS special_char_f1, round(avg(reference_id_exact), 9) AS reference_id_exact_match, round(avg(native_numeral_accuracy), 9) AS native_numeral_accuracy
      FROM banded {group}"""


BOXES = """boxes AS (SELECT l_orderkey, l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS seq,
    (l_partkey % 12)::DOUBLE AS x0, (l_suppkey % 4)::DOUBLE AS y0, (l_partkey % 12)::DOUBLE + 60.0::DOUBLE + l_quantity AS x1, (l_suppkey % 4)::DOUBLE + 20.0::DOUBLE AS y1 FROM lineitem)"""

_SIGNS = " | ".join(f"(CASE WHEN embedding[{i + 1}] > 0 THEN {1 << i}::UBIGINT ELSE 0::UBIGINT END)" for i in range(64))
_OWN = f"(SELECT vec_id, ({_SIGNS}) AS bits FROM embeddings)"
_SIGNED = f"""SELECT * FROM {_OWN} UNION ALL SELECT vec_id + 1000000, xor(bits, 1::UBIGINT << (vec_id % 63)::UBIGINT) FROM {_OWN} WHERE vec_id % 20 = 0
  UNION ALL SELECT vec_id + 2000000, bits FROM {_OWN} WHERE vec_id % 50 = 0"""
_NEAR = f"vecs AS ({_SIGNED}), near AS (SELECT a.vec_id AS later, b.vec_id AS earlier, CAST(bit_count(xor(a.bits, b.bits)) AS INTEGER) AS dist FROM vecs a JOIN vecs b ON a.vec_id > b.vec_id WHERE bit_count(xor(a.bits, b.bits)) <= 8)"

def _iou(a: str, b: str) -> str:
    inter = f"(greatest(0.0::DOUBLE, least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0)) * greatest(0.0::DOUBLE, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0)))"
    return f"{inter} / (({a}.x1 - {a}.x0) * ({a}.y1 - {a}.y0) + ({b}.x1 - {b}.x0) * ({b}.y1 - {b}.y0) - {inter})"


# a fold over the boxes of an order, in order: a box joins those that stay
GREEDY = f"""{BOXES}, listed AS (SELECT l_orderkey, list([struct_pack(seq := seq, x0 := x0, y0 := y0, x1 := x1, y1 := y1)] ORDER BY seq) AS bs FROM boxes GROUP BY 1),
stays AS (SELECT l_orderkey, unnest(list_reduce(bs, lambda acc, x: CASE WHEN len(list_filter(acc, lambda a: {_iou("a", "x[1]")} >= 0.85::DOUBLE)) = 0 THEN list_concat(acc, x) ELSE acc END)) AS b FROM listed)"""

_CLEAN = "translate(coalesce(text, ''), chr(8205) || chr(8204), '')"
ISSUES = rf"""CASE WHEN text IS NULL THEN 'null_text' ELSE concat_ws('|', CASE WHEN contains(text, chr(65533)) THEN 'replacement_character' END,
  CASE WHEN nfc_normalize({_CLEAN}) <> {_CLEAN} THEN 'not_nfc_normalized' END,
  array_to_string(list_transform(regexp_extract_all({_CLEAN}, '[\x00-\x08\x0B-\x1F\x7F-\x{{9F}}\p{{Cf}}\p{{Co}}]'), lambda c: 'control_char_U+' || printf('%04X', ord(c))), '|')) END"""

_TOKEN = "chr(list_position(u, t)::INTEGER)"
# each token of a pair is one byte, so the distance of strings is that of lists
TOKENS = f"""WITH {READINGS}, toks AS (SELECT item_id, backend, list_filter(string_split(r, ' '), lambda w: w <> '') AS rt, list_filter(string_split(h, ' '), lambda w: w <> '') AS ht FROM clean),
coded AS (SELECT *, list_distinct(list_concat(rt, ht)) AS u FROM toks),
wer AS (SELECT item_id, backend, CASE WHEN len(rt) = 0 THEN (len(ht) > 0)::INT::DOUBLE
  ELSE levenshtein(array_to_string(list_transform(rt, lambda t: {_TOKEN}), ''), array_to_string(list_transform(ht, lambda t: {_TOKEN}), ''))::DOUBLE / len(rt) END AS wer FROM coded)"""

SPANS = rf"""WITH {LINES}, w AS (SELECT seq, list_filter(regexp_split_to_array(text, '[{SPACE}]+'), lambda x: x <> '') AS ws FROM lines),
a AS (SELECT seq, ws, unnest(generate_series(0, len(ws) - 1)) AS i FROM w),
b AS (SELECT seq, ws, i, unnest(generate_series(i, least(len(ws) - 1, i + 25))) AS j FROM a),
c AS (SELECT seq, CAST(i AS INTEGER) AS span_i, CAST(j AS INTEGER) AS span_j, array_to_string(ws[i + 1:j + 1], ' ') AS span_text FROM b)
SELECT * FROM c WHERE NOT regexp_matches(span_text, '[0-9]') AND length(nfc_normalize(span_text)) BETWEEN 20 AND 25"""

TWINS = rf"""WITH {LINES}, d AS (SELECT text, min(seq) AS seq FROM lines GROUP BY 1),
t AS (SELECT seq, regexp_replace(nfc_normalize(text), '[{SPACE}]+', '', 'g') AS t FROM d),
k AS (SELECT seq, t, left(t, 16) AS k FROM t WHERE length(t) >= 16),
p AS (SELECT a.seq AS later, b.seq AS earlier, CASE WHEN length(a.t) <= length(b.t) THEN a.t ELSE b.t END AS s, CASE WHEN length(a.t) <= length(b.t) THEN b.t ELSE a.t END AS l
  FROM k a JOIN k b USING (k) WHERE a.seq > b.seq AND least(length(a.t), length(b.t)) >= greatest(length(a.t), length(b.t)) * 0.88::DOUBLE),
n AS (SELECT *, coalesce(list_min(list_filter(generate_series(1, length(s)), lambda i: substr(s, i, 1) <> substr(l, i, 1))), length(s) + 1) - 1 AS n FROM p),
f AS (SELECT later, earlier, n::DOUBLE / length(l) AS score FROM n WHERE n = length(s) OR (n >= 24 AND n >= length(s) * 0.88::DOUBLE))
SELECT * FROM f WHERE score >= 0.88::DOUBLE"""

_NAME = r"regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', ''), '([^/]*)/*$', 1)"
FILES = rf"""WITH a AS (SELECT page_id, {_NAME} AS raw FROM pages), b AS (SELECT page_id, regexp_replace(CASE WHEN raw = '' THEN 'doc_' || printf('%04d', page_id) || '.pdf' ELSE raw END, '[^\p{{L}}\p{{N}}_.-]+', '_', 'g') AS c FROM a)
SELECT page_id, printf('%04d', page_id) || '_' || CASE WHEN lower(c) LIKE '%.pdf' THEN c ELSE c || '.pdf' END AS name FROM b"""

_AREA = "(doc_id * 37 + line_no * 101) % 1800"
_TALL = "(doc_id * 13 + line_no * 7) % 240"
STAGE = f"""{LANED}, crop AS (SELECT *, {_AREA} AS w, {_TALL} AS h FROM laned),
seen AS (SELECT *, round(CASE WHEN w::DOUBLE / greatest(h, 1) >= 4.0 THEN 1.5::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN w >= 1200 THEN 0.8::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN h BETWEEN 40 AND 180 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END + 1.2::DOUBLE, 4) AS v FROM crop)
SELECT seq, CASE WHEN line_no % 10 <> 5 THEN difficulty WHEN v >= 3.0 THEN 'hard' ELSE 'normal' END AS difficulty, CASE WHEN line_no % 10 <> 5 THEN complexity_score ELSE v END AS complexity_score,
  CASE WHEN line_no % 10 <> 5 THEN hard_signal_source ELSE 'visual_provisional' END AS hard_signal_source, CASE WHEN line_no % 10 <> 5 THEN 'text' ELSE 'visual' END AS scoring_mode_used
FROM seen WHERE line_no % 10 = 5 OR difficulty <> 'reject'"""

TASKS = f"""{LANED} SELECT seq AS id, CASE WHEN seq % 6 = 0 OR seq % 4 <> 0 THEN text WHEN seq % 3 <> 0 THEN replace(text, 'e', 'c') ELSE '' END AS text,
  CASE WHEN seq % 3 <> 0 THEN replace(text, 'e', 'c') ELSE '' END AS ocr_prediction, difficulty AS intended_lane, source_id, {REGION} AS crop_type, word_count, char_count FROM laned"""


def _counts(name: str, key: str, least: int = 0) -> str:
    return f"""(SELECT '{{' || coalesce(string_agg('"' || k || '": ' || n, ', ' ORDER BY k), '') || '}}' FROM (SELECT {key} AS k, count(*) AS n FROM top GROUP BY 1 HAVING count(*) > {least})) AS {name}"""


_PACKED = """count(*) AS total_samples, count(*) FILTER (lane4 = 'hard') AS hard_samples, count(*) FILTER (lane4 = 'normal') AS normal_samples, 0::BIGINT AS ascii_digit_violations,
  count(*) FILTER (label = '') AS empty_text, count(DISTINCT source_id) AS sources_used"""
_OVER = "(SELECT count(*) FROM (SELECT source_id FROM top GROUP BY 1 HAVING count(*) > 8))"
_FULL = "count(*) FILTER (lane4 = 'hard') >= 80 AND count(*) FILTER (lane4 = 'normal') >= 20"
PACKAGE = f"""{ACCEPTED}, sums AS (SELECT *, sha256(label) AS d, CAST('0x' || substr(sha256(label), 1, 15) AS BIGINT) AS bits FROM top),
same AS (SELECT coalesce(sum(n - 1), 0)::BIGINT AS same FROM (SELECT count(*) AS n FROM sums GROUP BY d HAVING count(*) > 1)),
near AS (SELECT count(*) AS near FROM sums a JOIN sums b ON a.seq > b.seq AND bit_count(xor(a.bits, b.bits)) <= 8),
one AS (SELECT {_PACKED}, round(coalesce(avg(accepted_score), 0), 4) AS average_complexity_score, {_OVER} AS over_cap_sources, {_FULL} AS quota_met FROM top)
SELECT one.*, same AS duplicate_samples, near AS near_duplicate_samples, 0::BIGINT AS missing_images, {_counts("issue_type_counts", issue("label"))}, {_counts("gt_sources", "gt_source")},
  {_counts("per_source_counts", "source_id")}, {_counts("source_cap_violations", "source_id", 8)}, 0 AS ascii_digit_dropped, 0 AS text_near_duplicates,
  quota_met AND over_cap_sources = 0 AND same = 0 AND near = 0 AND empty_text = 0 AS gate_ok FROM one, same, near"""

ORACLES: dict[str, str] = {
    "unicode_issues": f"SELECT doc_id, {ISSUES} AS issues FROM documents",
    "unicode_report": f"SELECT doc_id, {ISSUES} = '' AS ok, {ISSUES} AS issues, sha256(nfc_normalize(coalesce(text, ''))) AS text_sha256 FROM documents",
    "word_spans": SPANS,
    "prefix_twins": TWINS,
    "file_names": FILES,
    "bbox_greedy_dedup": f"WITH {GREEDY} SELECT b.seq AS seq FROM stays",
    "crop_dedup": f"WITH {GREEDY}, keyed AS (SELECT b.seq AS seq, l_orderkey, (CAST(b.x0 AS BIGINT) * 7 + CAST(floor(b.x1) AS BIGINT)) % 40 AS part FROM stays) SELECT seq FROM keyed QUALIFY count(*) OVER (PARTITION BY l_orderkey, part) = 1",
    "page_links": """SELECT DISTINCT page_id, url AS source_page, regexp_extract(url, '^[a-z]+://[^/]+') || '/' || w || '.pdf' AS link FROM (SELECT page_id, url, unnest(regexp_extract_all(html, 'href="/([A-Za-z]+)"', 1)) AS w FROM pages)""",
    "ocr_word_metrics": f"{TOKENS} SELECT item_id, backend, wer, NULL::DOUBLE AS conjunct_error_rate, FALSE AS conjunct_applicable FROM wer",
    "score_stage": STAGE,
    "verdict_tasks": TASKS,
    "seed_benchmark": "SELECT 'images/' || item_id || '.png' AS image_filename, text AS expected_text, CASE WHEN item_id % 2 = 0 THEN 'date_issue' ELSE '' END AS issue_type, regexp_matches(coalesce(text, ''), '[0-9]') AS contains_native_digits FROM benchmark WHERE item_id % 7 <> 0",
    "export_report": f"{ACCEPTED} SELECT {_PACKED}, round(coalesce(avg(accepted_score), 0), 6) AS average_complexity_score, {_OVER} AS over_cap_sources, {_FULL} AS quota_met, {_FULL} AND count(*) FILTER (label = '') = 0 AND {_OVER} = 0 AS gate_ok FROM top",
    "package_report": PACKAGE,
    "line_units": f"WITH {LINES} SELECT doc_id, line_no, seq, text, {WORDS} AS word_count FROM lines",
    "text_features": f"WITH {LINES}, {FEATURES} SELECT seq, native_digit_count, ascii_digit_count, slash_count, period_count, comma_count, hyphen_count, dash_count, colon_count, semicolon_count, bracket_count, symbol_count, currency_count, percent_count, conjunct_estimate, matra_score, text_length, char_count, word_count, numeric_density, special_character_density, identifier_likeness_score, reference_pattern_score, dense_text_score FROM feats",
    "complexity_score": f"{LANED} SELECT seq, raw_score, score AS complexity_score FROM scored",
    "identifier_likeness": f"WITH {LINES}, {FEATURES} SELECT seq, identifier_likeness_score AS score FROM feat",
    "lane_classify": f"{LANED} SELECT seq, difficulty, complexity_score, hard_signal_source, reject_reason FROM laned",
    "lane_summary": f"{LANED} SELECT difficulty, hard_signal_source, count(*) AS n, sum(CAST(round(complexity_score * 10000) AS BIGINT))::DOUBLE / count(*) / 10000.0::DOUBLE AS mean_score FROM laned GROUP BY 1, 2",
    "llm_relabel": f"{RELABELLED} SELECT seq, difficulty, complexity_score, hard_signal_source, reject_reason, review_status FROM reviewed",
    "verdict_stats": f"{RELABELLED} SELECT count(*) AS ran, count(*) FILTER (mode = 'vision') AS vision, 0::BIGINT AS text_fallback, count(*) FILTER (exact_match) AS exact_match, count(*) FILTER (complex) AS complex_hard, count(*) FILTER (told = 'hard') AS lane_hard, count(*) FILTER (told = 'normal') AS lane_normal, count(*) FILTER (told = 'reject') AS lane_reject, count(*) FILTER (used) AS lane_applied, count(*) FILTER (review_status = 'needs_llm_attention') AS suspicious FROM reviewed",
    "soft_fail_demote": f"{LANED} SELECT seq, CASE WHEN difficulty = 'hard' AND NOT (is_strong AND seq % 2 = 0) THEN 'reject' ELSE difficulty END AS difficulty, CASE WHEN difficulty <> 'hard' THEN hard_signal_source WHEN is_strong AND seq % 2 = 0 THEN 'heuristic_strong_soft_fail' ELSE 'demoted_soft_fail' END AS hard_signal_source, CASE WHEN difficulty = 'hard' AND NOT (is_strong AND seq % 2 = 0) THEN 'hard_unconfirmed_llm_soft_fail' END AS reject_reason FROM laned",
    "region_type": f"WITH {LINES} SELECT seq, {REGION} AS region FROM lines",
    "issue_type": f"WITH {LINES} SELECT seq, {issue('text')} AS issue FROM lines",
    "ground_truth_issues": f"WITH {LINES}, c AS (SELECT seq, length({strip('text')}) AS n, {WORDS} AS w FROM lines), i AS (SELECT seq, concat_ws('|', CASE WHEN n < 10 THEN 'too_short' END, CASE WHEN w < 2 THEN 'too_few_words' END, CASE WHEN w > 50 THEN 'too_many_words:' || w || '>50' END, CASE WHEN n < 10 THEN 'too_few_chars:' || n || '<10' END, CASE WHEN n > 200 THEN 'too_many_chars:' || n || '>200' END) AS issues FROM c) SELECT seq, issues, issues = '' AS ok FROM i",
    "encoding_ok": f"WITH {LINES} SELECT seq, NOT regexp_matches(text, '[^{SPACE}A-Za-z{LETTERS}\\p{{P}}\\p{{S}}\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]') AS ok FROM lines",
    "exact_text_dedup": f"WITH {LINES} SELECT seq, text FROM lines QUALIFY row_number() OVER (PARTITION BY text ORDER BY seq) = 1",
    "exact_hash_groups": "SELECT sha256(text) AS sha256, count(*) AS n, min(doc_id) AS first_item FROM documents GROUP BY 1 HAVING count(*) > 1",
    "hamming_pairs": f"WITH {_NEAR} SELECT * FROM near",
    "image_dedup": f"WITH {_NEAR} SELECT vec_id FROM vecs WHERE vec_id NOT IN (SELECT earlier FROM near) AND vec_id IN (SELECT min(vec_id) FROM vecs GROUP BY bits)",
    "bbox_iou_pairs": f"WITH {BOXES}, p AS (SELECT a.seq AS later, b.seq AS earlier, greatest(0.0::DOUBLE, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0.0::DOUBLE, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS i, (a.x1 - a.x0) * (a.y1 - a.y0) AS aa, (b.x1 - b.x0) * (b.y1 - b.y0) AS bb FROM boxes a JOIN boxes b USING (l_orderkey) WHERE a.seq > b.seq), q AS (SELECT later, earlier, CASE WHEN i > 0 THEN i / (aa + bb - i) ELSE 0.0::DOUBLE END AS iou FROM p) SELECT * FROM q WHERE iou >= 0.85",
    "dual_lane_pick": f"{_PICK} SELECT seq, source_id, difficulty, pick_rank FROM placed WHERE pick_rank <= 8",
    "lane_select": f"{_SELECT} SELECT seq, source_id, difficulty, CAST(r AS INTEGER) AS selection_rank FROM sel",
    "selection_stats": f"{_SELECT} SELECT t.lane, t.target, count(s.seq) AS selected, count(DISTINCT s.source_id) AS sources_used, greatest(t.target - count(s.seq), 0) AS shortfall FROM (VALUES ('hard', 80), ('normal', 20)) t(lane, target) LEFT JOIN sel s ON s.difficulty = t.lane GROUP BY 1, 2",
    "choose_label": f"{LABELLED} SELECT seq, label, gt_source, label_reason AS reason FROM chosen",
    "accept_chain": f"{ACCEPTED} SELECT seq, CASE WHEN reason IS NULL THEN 'verified' ELSE 'rejected' END AS review_status, reason, gt_source, label, accepted_lane FROM reasoned",
    "accept_report": f"{ACCEPTED} SELECT CASE WHEN reason IS NULL THEN 'verified' ELSE 'rejected' END AS review_status, CASE WHEN reason IS NULL THEN gt_source END AS gt_source, CASE WHEN reason IS NULL THEN accepted_lane END AS lane, reason, count(*) AS n FROM reasoned GROUP BY ALL",
    "export_gate": f"{ACCEPTED} SELECT seq, lane4 AS difficulty, label AS expected_text FROM exported",
    "export_public": f"{ACCEPTED} SELECT '/images/' || lpad(CAST(row_number() OVER (ORDER BY CASE WHEN lane4 = 'hard' THEN 0 ELSE 1 END, seq) AS VARCHAR), 4, '0') || '.png' AS image_filename, label AS expected_text, {issue('label')} AS issue_type FROM top",
    "ocr_metrics": f"{PAIRS} SELECT item_id, backend, latency_ms, cer, cer_strict, cer_normalized, exact_match, exact_match_strict, native_numeral_accuracy, ascii_digit_contamination, gt_has_native_digits, ascii_digit_count_in_pred, special_char_accuracy, special_char_precision, special_char_recall, special_char_f1, is_reference_like, reference_id_exact, char_count, word_count, char_band, word_band, issue_type, source_id FROM banded",
    "ocr_metric_slices": f"{PAIRS} " + " UNION ALL ".join([_slice("all", "'all'"), *[_slice(f"by_{s}", s) for s in ("issue_type", "contains_native_digits", "source_id", "char_band", "word_band")]]),
    "ocr_source_topn": f"{PAIRS}, g AS (SELECT source_id, count(*) AS n, round(avg(cer), 9) AS cer, round(avg(exact_match::INT::DOUBLE), 9) AS exact_match FROM banded GROUP BY 1), r AS (SELECT *, CAST(row_number() OVER (ORDER BY n DESC, source_id) AS INTEGER) AS rank, count(*) OVER () AS n_sources FROM g) SELECT *, greatest(n_sources - 40, 0) AS omitted_sources FROM r WHERE rank <= 40",
    "latency_percentiles": f"{PAIRS} SELECT backend, round(quantile_cont(latency_ms, 0.5), 9) AS latency_ms_p50, round(quantile_cont(latency_ms, 0.95), 9) AS latency_ms_p95, count(latency_ms) AS latency_samples FROM banded GROUP BY 1",
    "backend_scores": f"{PAIRS}, s AS (SELECT backend, avg(exact_match::INT::DOUBLE) AS em, avg(native_numeral_accuracy) AS num, avg(special_char_f1) AS f1, avg(special_char_accuracy) AS acc, avg(reference_id_exact) AS ref, avg(cer) AS cer FROM banded GROUP BY 1) SELECT backend, round(em * 3 + num * 2 + coalesce(nullif(f1, 0), acc, 0) * 1.5::DOUBLE + coalesce(ref, 0) * 2 - cer * 2, 9) AS score FROM s",
    "url_first_wins": "SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS site, page_id, url FROM pages QUALIFY row_number() OVER (PARTITION BY regexp_extract(url, '^https?://([^/?#]+)', 1) ORDER BY page_id) = 1",
    "url_exclude": "WITH e AS (SELECT DISTINCT lower(trim(regexp_extract(url, '^https?://([^/?#]+)', 1))) AS entry FROM pages WHERE page_id % 10 = 0) SELECT page_id, url AS link FROM pages p WHERE NOT EXISTS (SELECT 1 FROM e WHERE entry <> '' AND NOT starts_with(entry, '#') AND length(entry) > 8 AND contains(lower(p.url), entry))",
    "html_to_text": f"SELECT page_id, trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g'), '[{SPACE}]+', ' ', 'g')) AS text FROM pages",
    "cache_join": "WITH d AS (SELECT doc_id, sha256(text) AS s FROM documents), c AS (SELECT s, min(doc_id) AS any_id FROM d WHERE doc_id % 2 = 0 AND doc_id % 6 <> 0 GROUP BY 1) SELECT d.doc_id, CASE WHEN c.s IS NOT NULL THEN 'r' || substr(d.s, 1, 4) END AS payload, c.s IS NOT NULL AS from_cache FROM d LEFT JOIN c USING (s)",
    "resume_antijoin": "SELECT doc_id FROM documents WHERE doc_id % 2 <> 0 OR doc_id % 4 <> 0",
    "manifest_upsert": "SELECT source || '_' || substr(sha1(CAST(doc_id AS VARCHAR)), 1, 8) AS source_id, lang, CASE WHEN doc_id % 3 = 0 THEN 'new' ELSE 'old' END AS state FROM documents",
    "render_boxes": f"WITH {BOXES}, e AS (SELECT seq, greatest(0, CAST(round_even(x0 * (600 / 180::DOUBLE), 0) AS INTEGER) - 28) AS l, greatest(0, CAST(round_even(y0 * (600 / 180::DOUBLE), 0) AS INTEGER) - 8) AS t, least(200, CAST(round_even(x1 * (600 / 180::DOUBLE), 0) AS INTEGER) + 28) AS r, least(80, CAST(round_even(y1 * (600 / 180::DOUBLE), 0) AS INTEGER) + 8) AS b FROM boxes) SELECT seq, l AS \"left\", t AS top, r - l AS width, b - t AS height FROM e",
    "image_rules": "WITH i AS (SELECT l_orderkey, l_linenumber, l_partkey, l_partkey % 2000 AS w, l_suppkey % 500 AS h, l_quantity AS q FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, concat_ws('|', CASE WHEN w < 800 THEN 'narrow_width' END, CASE WHEN h < 100 THEN 'short_height' END, CASE WHEN h > 400 THEN 'too_tall' END, CASE WHEN w::DOUBLE / greatest(h, 1) < 4.0 THEN 'low_aspect' END, CASE WHEN q < 20 THEN 'blurry' END, CASE WHEN q / 2 < 15 THEN 'low_contrast' END) AS issues FROM i",
    "downloads": "WITH p AS (SELECT page_id AS seq, sha256(html) AS s, page_id % 7 = 0 AS failed, page_id % 5 = 0 AS skipped FROM pages), m AS (SELECT *, NOT failed AND NOT skipped AND row_number() OVER (PARTITION BY s, NOT failed AND NOT skipped ORDER BY seq) = 1 AS fresh FROM p), b AS (SELECT *, coalesce(sum(fresh::INT) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m) SELECT seq, CASE WHEN skipped THEN 'already_ingested' WHEN failed THEN 'failed' WHEN fresh THEN 'new' ELSE 'deduped' END AS status FROM b WHERE before < 100",
    "global_topk": f"{LANED}, t AS (SELECT seq, difficulty, complexity_score, word_count, row_number() OVER (PARTITION BY difficulty ORDER BY CASE WHEN difficulty = 'hard' THEN complexity_score ELSE word_count::DOUBLE END DESC, seq) AS r, count(*) FILTER (difficulty = 'hard') OVER () AS h, count(*) FILTER (difficulty = 'normal') OVER () AS n FROM laned WHERE difficulty IN ('hard', 'normal')), k1 AS (SELECT *, least(n, 40) AS n0, least(h, 200 - least(n, 40)) AS h0 FROM t), k2 AS (SELECT *, CASE WHEN h0 < 200 - n0 THEN least(n, 200 - h0) ELSE n0 END AS n1 FROM k1), k3 AS (SELECT *, CASE WHEN n1 + h0 < 200 THEN least(h, 200 - n1) ELSE h0 END AS h1 FROM k2) SELECT seq, difficulty, CAST(CASE WHEN difficulty = 'hard' THEN r ELSE h1 + r END AS INTEGER) AS position FROM k3 WHERE r <= CASE WHEN difficulty = 'hard' THEN h1 ELSE n1 END",
    "quota_scale": "WITH a AS (SELECT o_orderkey, CAST(o_orderkey % 1003 AS INTEGER) AS n FROM orders), b AS (SELECT o_orderkey, CASE WHEN n % 5 <> 0 THEN n END AS t, CASE WHEN n % 7 = 0 THEN n % 90 END AS h, CASE WHEN n % 11 = 0 THEN n % 40 END AS m, CASE WHEN n % 2 = 0 THEN 80 ELSE 3 END AS bh, 20 AS bn FROM a), c AS (SELECT *, CASE WHEN t >= 2 THEN greatest(1, least(t - 1, CAST(round_even(t * (bh::DOUBLE / (bh + bn)), 0) AS INTEGER))) ELSE greatest(0, least(t, CAST(round_even(t * (bh::DOUBLE / (bh + bn)), 0) AS INTEGER))) END AS share FROM b), d AS (SELECT *, CASE WHEN h IS NOT NULL AND m IS NOT NULL THEN h WHEN t IS NOT NULL AND h IS NOT NULL THEN least(h, t) WHEN t IS NOT NULL AND m IS NOT NULL THEN t - least(m, t) WHEN t IS NOT NULL THEN share WHEN h IS NOT NULL THEN h ELSE bh END AS hard_target FROM c) SELECT o_orderkey, hard_target, CASE WHEN h IS NOT NULL AND m IS NOT NULL THEN m WHEN t IS NOT NULL THEN t - hard_target WHEN m IS NOT NULL THEN m ELSE bn END AS normal_target FROM d",
    "image_verdict": "SELECT doc_id, quality = 1 AS exact_match, quality <> 1 AS visible_differs, CASE WHEN doc_id % 3 = 0 THEN TRUE WHEN doc_id % 3 = 1 THEN FALSE END AS is_complex_for_ocr, CASE WHEN doc_id % 3 = 0 THEN 'hard' WHEN doc_id % 3 = 1 THEN 'normal' END AS suggested_lane, NOT (quality = 1 AND toxic <> 1) AS suspicious FROM labels",
    "json_extract": "SELECT event_id, props AS json FROM events",
}

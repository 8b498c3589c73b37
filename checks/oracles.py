"""The same results as plain SQL over the given tables."""

from __future__ import annotations

from checks.fixtures import DOCS_PER_FILE, SMALL_MERGES, small_merge_ids, small_unigram
from checks.queries import FINETUNE, PAIR_LEN, PRETRAIN, SEQ_LEN
from corploom.functions.arrays import IGNORE_LABEL
from corploom.functions.tokenizers import BYTES_EOS, DEFAULT_EOS_TEXT, WORD_VOCAB
from corploom.operators.feistel import FIRST, MODULUS, ROUNDS, SECOND
from corploom.operators.instructions import CONTEXT_HEAD, INSTRUCTION_HEAD, RESPONSE_HEAD

BPE_EOS = 256 + len(SMALL_MERGES)


def word_id(word: str) -> str:
    return f"CAST(CAST('0x' || substr(md5({word}), 1, 8) AS BIGINT) % {WORD_VOCAB} AS INTEGER)"


def words(text: str) -> str:
    parts = rf"list_filter(string_split_regex({text}, '[ \t\n\r]+'), lambda w: w <> '')"
    return f"list_transform({parts}, lambda w: {word_id('w')})"


def byte_ids(text: str) -> str:
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    return f"list_transform({pairs}, lambda h: CAST('0x' || h AS INTEGER))"


def text_of(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


EOS_TEXT_ID = word_id(f"'{DEFAULT_EOS_TEXT}'")
WORDS = f"SELECT doc_id, {words('text')} AS ids FROM documents"
WORDS_EOS = f"SELECT doc_id, list_append({words('text')}, {WORD_VOCAB}) AS ids FROM documents"
FILES = f"""SELECT doc_id // {DOCS_PER_FILE} AS doc_id, list_append(flatten(list({words('text')} ORDER BY doc_id)), {WORD_VOCAB}) AS ids
FROM documents GROUP BY doc_id // {DOCS_PER_FILE}"""
WORDS_EOS_TEXT = f"SELECT doc_id, list_append({words('text')}, {EOS_TEXT_ID}) AS ids FROM documents"
BYTES = f"SELECT doc_id, {byte_ids('text')} AS ids FROM documents"
BYTES_EOS_SQL = f"SELECT doc_id, list_append({byte_ids('text')}, {BYTES_EOS}) AS ids FROM documents"


def pieces() -> str:
    """The best path of each distinct part, place by place, then its ids from the end to the front."""
    tok = small_unigram()
    known = ", ".join(f"('{piece}', {{'id': {number}, 'score': {score}}})" for piece, (number, score) in tok.pieces.items())
    longest = max(map(len, tok.pieces))
    return rf"""WITH RECURSIVE known AS (SELECT map_from_entries([{known}]) AS m),
    texts AS (SELECT doc_id, regexp_extract_all(CASE WHEN text = '' THEN '' ELSE '▁' || replace(text, ' ', '▁') END, '▁?[^▁]+|▁') AS parts
        FROM documents WHERE text IS NOT NULL),
    words AS (SELECT DISTINCT unnest(parts) AS w FROM texts),
    walk AS (SELECT w, 0 AS spot, [CAST(0 AS BIGINT)] AS sums, CAST([] AS INTEGER[]) AS starts FROM words
        UNION ALL
        SELECT w, spot + 1, list_append(sums, found.score), list_append(starts, found.start) FROM (
            SELECT w, spot, sums, starts, list_reduce(list_filter(list_transform(range(greatest(0, spot + 1 - {longest}), spot + 1), lambda s:
                {{'start': CAST(s AS INTEGER), 'score': sums[s + 1] + coalesce(m[substr(w, s + 1, spot + 1 - s)].score,
                    CASE WHEN s = spot THEN {tok.floor} END)}}), lambda c: c.score IS NOT NULL),
                lambda a, b: CASE WHEN b.score > a.score THEN b ELSE a END) AS found
            FROM walk, known WHERE spot < length(w)) step),
    back AS (SELECT w, starts, length(w) AS spot, CAST([] AS INTEGER[]) AS ids FROM walk WHERE spot = length(w)
        UNION ALL
        SELECT w, starts, starts[spot], list_concat(CASE WHEN m[substr(w, starts[spot] + 1, spot - starts[spot])].id IS NOT NULL
            THEN [m[substr(w, starts[spot] + 1, spot - starts[spot])].id]
            ELSE list_transform(regexp_extract_all(hex(encode(substr(w, spot, 1))), '..'), lambda h: {tok.bytes_from} + CAST('0x' || h AS INTEGER)) END, ids)
        FROM back, known WHERE spot > 0),
    coded AS (SELECT w, ids FROM back WHERE spot = 0),
    laid AS (SELECT doc_id, unnest(parts) AS w, generate_subscripts(parts, 1) AS i FROM texts)
    SELECT t.doc_id, coalesce(x.ids, []) AS ids FROM texts t
    LEFT JOIN (SELECT doc_id, flatten(list(ids ORDER BY i)) AS ids FROM laid JOIN coded USING (w) GROUP BY doc_id) x USING (doc_id)"""


def bpe(eos: bool) -> str:
    """Pre-tokens, their bytes as <id> marks, then one replacement per merge.

    Merges are in the order they were made, so a pair can only appear through
    earlier merges, and replacing pair after pair equals always merging the
    pair that comes first in the list.
    """
    # white space before a word keeps its last character for the word
    marked = r"regexp_replace(text, '(\s)(\s\S)', '\1' || chr(57344) || '\2', 'g')"
    form = (
        r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x{E000}]+|\s+"
    ).replace("'", "''")
    merged = (
        "array_to_string(list_transform(regexp_extract_all(hex(encode(p)), '..'),"
        " lambda h: '<' || CAST('0x' || h AS INTEGER) || '>'), '')"
    )
    for left, right, both in small_merge_ids():
        merged = f"replace({merged}, '<{left}><{right}>', '<{both}>')"
    ids = f"list_transform(regexp_extract_all({merged}, '[0-9]+'), lambda d: CAST(d AS INTEGER))"
    end = f"list_append(list(id ORDER BY i, j), {BPE_EOS})" if eos else "list(id ORDER BY i, j)"
    return f"""
    WITH parts AS (
      SELECT doc_id, unnest(regexp_extract_all({marked}, '{form}')) AS p,
             generate_subscripts(regexp_extract_all({marked}, '{form}'), 1) AS i
      FROM documents),
    vocab AS (SELECT p, {ids} AS ids FROM (SELECT DISTINCT p FROM parts)),
    flat AS (
      SELECT doc_id, i, unnest(ids) AS id, generate_subscripts(ids, 1) AS j
      FROM parts JOIN vocab USING (p))
    SELECT doc_id, {end} AS ids FROM flat GROUP BY doc_id"""


def tokens_out(docs: str) -> str:
    return f"""SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_tokens, {text_of('ids')} AS tokens
    FROM ({docs}) d"""


def offsets(docs: str, key: str = "doc_id") -> str:
    return f"""SELECT {key}, ids, CAST(len(ids) AS INTEGER) AS n_tokens,
      CAST(row_number() OVER (ORDER BY {key}) - 1 AS BIGINT) AS doc_ord,
      CAST(coalesce(sum(len(ids)) OVER (ORDER BY {key} ROWS BETWEEN UNBOUNDED PRECEDING
        AND 1 PRECEDING), 0) AS BIGINT) AS tok_offset,
      count(*) OVER () AS n_docs
    FROM ({docs}) d"""


def packed(docs: str, seq_len: int = SEQ_LEN, keep_tail: bool = False) -> str:
    having = "" if keep_tail else f"HAVING count(*) = {seq_len}"
    return f"""SELECT CAST(pos // {seq_len} AS BIGINT) AS sample_id, list(id ORDER BY pos) AS ids
    FROM (SELECT unnest(ids) AS id, tok_offset + generate_subscripts(ids, 1) - 1 AS pos
          FROM ({offsets(docs)}) o) f
    GROUP BY pos // {seq_len} {having}"""


def samples_out(samples: str, more: str = "") -> str:
    return f"""SELECT sample_id, CAST(len(ids) AS INTEGER) AS n_tokens, ids[1] AS first_token,
      ids[-1] AS last_token, {text_of('ids')} AS tokens {more}
    FROM ({samples}) s"""


def in_splits(query: str, names=("train", "val")) -> str:
    values = ", ".join(f"('{n}')" for n in names)
    return f"SELECT q.*, n.split FROM ({query}) q CROSS JOIN (VALUES {values}) n(split)"


SUBSETS = """SELECT doc_id, text, lang AS subset,
  CASE WHEN doc_id % 10 = 0 THEN 'val_small' ELSE 'train_small' END AS split FROM documents"""

RECORDS = """SELECT u.conv_id * 1048576 + u.turn AS sample_id, u.text AS instruction,
  coalesce(s.text, '') AS context, a.text AS response
FROM conversations u
JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
LEFT JOIN conversations s ON s.conv_id = u.conv_id AND s.turn = 0 AND s.role = 'system'
WHERE u.role = 'user'"""


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PAIRS = f"""SELECT sample_id, {literal(INSTRUCTION_HEAD)} || instruction
  || CASE WHEN trim(context) = '' THEN '' ELSE {literal(CONTEXT_HEAD)} || context END
  || {literal(RESPONSE_HEAD)} AS prompt, response
FROM ({RECORDS}) r"""


def pair_arrays(max_len: int | None) -> str:
    cut = f"[1:{max_len}]" if max_len else ""
    return f"""SELECT sample_id, list_concat(p, r){cut} AS input_ids,
      list_concat(list_transform(p, lambda x: {IGNORE_LABEL}), r){cut} AS labels,
      list_transform(list_concat(p, r), lambda x: 1){cut} AS attention_mask
    FROM (SELECT sample_id, {words('prompt')} AS p, {words('response')} AS r FROM ({PAIRS}) q) w"""


def padded(col: str, value: int, length: str) -> str:
    return f"list_concat({col}, list_transform(range({length} - len({col})), lambda x: {value}))"


def arrays_out(rows: str, pad_id: int | None = None, length: str = str(PAIR_LEN), more: str = "") -> str:
    fills = {"input_ids": pad_id, "labels": IGNORE_LABEL, "attention_mask": 0}
    cols = ", ".join(
        f"{text_of(c if pad_id is None else padded(c, v, length))} AS {c}" for c, v in fills.items()
    )
    return f"SELECT sample_id {more}, {cols} FROM ({rows}) a"


def plan(ids: str, recipe, shuffle: bool = True, limit: str | None = None) -> str:
    """``ids`` gives sample_id; adds epoch, rank, batch, global_batch."""
    b = recipe.global_batch
    per = f"(n // {b})" if recipe.drop_last else f"((n + {b - 1}) // {b})"
    epochs = int(recipe.max_duration[:-2]) if recipe.max_duration.endswith("ep") else None
    last = limit or f"{epochs} * {per}"
    order = f"md5('{recipe.seed}:' || e || ':' || sample_id), sample_id" if shuffle else "sample_id"
    return f"""SELECT sample_id, CAST(e AS INTEGER) AS epoch, rank, batch, e * per + batch AS global_batch
    FROM (SELECT sample_id, e, {per} AS per, {last} AS lim, rank, CAST(rank // {b} AS BIGINT) AS batch
      FROM (SELECT sample_id, e, n,
              CAST(row_number() OVER (PARTITION BY e ORDER BY {order}) - 1 AS BIGINT) AS rank
        FROM (SELECT sample_id, n, unnest(range(({last} + {per} - 1) // {per})) AS e
          FROM (SELECT sample_id, count(*) OVER () AS n FROM ({ids}) i) c) x) r) p
    WHERE batch < per AND e * per + batch < lim"""


def device_cols(batch: int, devices: int, micro: int, rank: str = "rank") -> str:
    per = batch // devices
    return f"""CAST({rank} % {batch} AS INTEGER) AS pos,
      CAST(({rank} % {batch}) // {per} AS INTEGER) AS device,
      CAST((({rank} % {batch}) % {per}) // {micro} AS INTEGER) AS micro"""


def marker_cols(eval_every: int, save_every: int, eval_first: bool) -> str:
    first = " OR global_batch = 0" if eval_first else ""
    return f"""((global_batch + 1) % {eval_every} = 0{first}) AS is_eval,
      ((global_batch + 1) % {save_every} = 0) AS is_save"""


def full_plan(ids: str, recipe) -> str:
    marks = marker_cols(recipe.eval_interval, recipe.save_interval, recipe.eval_first)
    return f"""SELECT epoch, global_batch, batch,
      {device_cols(recipe.global_batch, recipe.devices, recipe.micro_size)}, sample_id, {marks}
    FROM ({plan(ids, recipe)}) b"""


SAMPLES = packed(WORDS_EOS)
SAMPLE_IDS = f"SELECT sample_id FROM ({SAMPLES}) s"
RANKED_IDS = f"""SELECT sample_id, CAST(row_number() OVER (ORDER BY sample_id) - 1 AS BIGINT) AS rank,
  count(*) OVER () AS n FROM ({SAMPLES}) s"""

EVENT_RANKS = """SELECT user_id, event_id,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS rank,
  event_type, value, ts FROM events"""
LINES = f"""SELECT CAST(user_id AS VARCHAR) AS run_id, CAST(rank // 2 AS BIGINT) AS batch, ts,
  CAST(event_id % 8 AS INTEGER) AS device, CAST(floor(value * 100) AS BIGINT) AS tokens,
  value AS loss, 1.0::DOUBLE / (rank // 2 + 1)::DOUBLE * (1 + rank % 2) AS lr,
  CAST(event_id * 1024 + CAST(floor(value * 100) AS BIGINT) AS BIGINT) AS mem_bytes,
  event_type = 'error' AS is_note,
  'error user=' || user_id || ' event=' || event_id AS note
FROM ({EVENT_RANKS}) e"""
METRICS = f"SELECT * FROM ({LINES}) l WHERE NOT is_note"

SPEED = f"""SELECT run_id, batch, ts_us, tokens,
  CASE WHEN n = 10 AND ts_us > first_us
    THEN (total - first_tokens)::DOUBLE / ((ts_us - first_us)::DOUBLE / 1e6::DOUBLE) END AS tokens_per_sec,
  CASE WHEN n = 10 AND ts_us > first_us
    THEN 9::DOUBLE / ((ts_us - first_us)::DOUBLE / 1e6::DOUBLE) END AS batches_per_sec
FROM (SELECT *, count(*) OVER w AS n, sum(tokens) OVER w AS total,
        first_value(tokens) OVER w AS first_tokens, first_value(ts_us) OVER w AS first_us
  FROM (SELECT run_id, batch, epoch_us(max(ts)) AS ts_us, CAST(sum(tokens) AS BIGINT) AS tokens
        FROM ({METRICS}) m GROUP BY run_id, batch) b
  WINDOW w AS (PARTITION BY run_id ORDER BY batch ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) s"""
ETA = f"""SELECT *, greatest(1000 - batch - 1, 0)::DOUBLE / batches_per_sec AS eta_sec FROM ({SPEED}) q"""
MEMORY = f"SELECT run_id, batch, max(mem_bytes) AS peak_bytes FROM ({METRICS}) m GROUP BY run_id, batch"
LR = f"""SELECT run_id, batch, arg_max(lr, epoch_us(ts) * 8 + device) AS lr FROM ({METRICS}) m GROUP BY run_id, batch"""

LOG_COUNTS = f"""SELECT CASE WHEN is_note THEN note ELSE
  '{{"run_id":"' || run_id || '","batch":' || batch || ',"ts":"'
  || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '","device":' || device || ',"tokens":' || tokens
  || ',"mem_bytes":' || mem_bytes || '}}' END AS line, count(*) AS n
FROM ({LINES}) l GROUP BY 1"""


FEISTEL = f"""WITH RECURSIVE ids AS (SELECT sample_id FROM ({SAMPLES}) s),
  size AS (SELECT count(*) AS n, (SELECT min(j) FROM range(1, 31) t(j) WHERE (1::BIGINT << (2 * j)) >= (SELECT count(*) FROM ids)) AS b FROM ids),
  keys AS (
    SELECT e AS epoch, list(CAST('0x' || substr(md5('{PRETRAIN.seed}:' || e || ':' || i), 1, 8) AS BIGINT) % {MODULUS} ORDER BY i) AS k
    FROM range(3) a(e), range({ROUNDS}) c(i) GROUP BY e),
  walk AS (
    SELECT k.epoch, i.sample_id, i.sample_id >> s.b AS l, i.sample_id & ((1::BIGINT << s.b) - 1) AS r, 0 AS step
    FROM ids i, size s, keys k
    UNION ALL
    SELECT epoch, sample_id, r, xor(l, xor(y, y >> 13) & ((1::BIGINT << b) - 1)), step + 1
    FROM (SELECT *, (xor(x, x >> 15) * {SECOND}) % {MODULUS} AS y
          FROM (SELECT w.*, s.b, (w.r * {FIRST} + k.k[w.step % {ROUNDS} + 1]) % {MODULUS} AS x
                FROM walk w JOIN keys k USING (epoch), size s
                WHERE w.step = 0 OR w.step % {ROUNDS} > 0 OR ((w.l << s.b) | w.r) >= s.n) a) c)
SELECT w.sample_id, CAST(w.epoch AS INTEGER) AS epoch, (w.l << s.b) | w.r AS position
FROM walk w, size s WHERE w.step > 0 AND w.step % {ROUNDS} = 0 AND ((w.l << s.b) | w.r) < s.n"""


def by_split(packed_by: str) -> str:
    """Each split of the English subset packed on its own."""
    one = "SELECT doc_id, list_append({w}, {eos}) AS ids FROM documents WHERE lang = 'en' AND doc_id % 10 {op} 0"
    halves = []
    for name, op in (("train_small", "<>"), ("val_small", "=")):
        docs = one.format(w=words("text"), eos=EOS_TEXT_ID, op=op)
        halves.append(samples_out(packed(docs), f", '{name}' AS split"))
    return " UNION ALL ".join(halves)


def weighted(rank: str, total: str) -> str:
    return f"""CASE WHEN {rank} < ({total} * 2 * 949 + 1000) // 2000 THEN 'train'
      WHEN {rank} < ({total} * 2 * 999 + 1000) // 2000 THEN 'valid' ELSE 'test' END"""


FT_ROWS = f"""SELECT f.*, len(a.input_ids) AS used, a.input_ids, a.labels, a.attention_mask
FROM ({full_plan(f'SELECT sample_id FROM ({PAIRS}) p', FINETUNE)}) f
JOIN ({pair_arrays(PAIR_LEN)}) a USING (sample_id)"""

FT_COLUMNS = "epoch, global_batch, batch, device, micro, pos, sample_id, is_eval, is_save"


def ft_out(columns: str, rows: str, length: str) -> str:
    """Padded arrays of plan rows that have ``used``."""
    return f"""SELECT {columns}, CAST(used AS INTEGER) AS n_tokens, CAST({length} AS INTEGER) AS n_padded,
        {text_of(padded('input_ids', WORD_VOCAB, length))} AS input_ids,
        {text_of(padded('labels', IGNORE_LABEL, length))} AS labels,
        {text_of(padded('attention_mask', 0, length))} AS attention_mask FROM ({rows}) r"""


ORACLES = {
    "scan_jsonl": "SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n_chars FROM documents",
    "scan_jsonl_bad_lines": """SELECT doc_id, text AS content FROM documents
        UNION ALL SELECT NULL AS doc_id, content FROM (
          SELECT unnest(string_split(text, chr(10))) AS content FROM benchmark) b
        WHERE trim(content) <> ''""",
    "scan_order": "SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS rank, text FROM documents",
    "scan_text_folder": "SELECT doc_id, text || chr(10) AS text FROM documents",
    "scan_dataset": f"SELECT doc_id, subset, split, text FROM ({SUBSETS}) s WHERE subset = 'en'",
    "scan_instructions": f"SELECT *, 'train' AS split FROM ({RECORDS}) r",
    "scan_shards": samples_out(SAMPLES, ", 'val' AS split"),
    "scan_logs": LOG_COUNTS,
    "follow_logs": LOG_COUNTS,
    "preview": "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 10",
    "write_shards": samples_out(SAMPLES, ", 'train' AS split"),
    "write_split_folders": in_splits(samples_out(SAMPLES)),
    "split_manifests": " UNION ALL ".join(
        f"""SELECT '{split}' AS split, count(*) AS n_read, count(*) AS n_samples,
        CAST(sum(len(ids)) AS BIGINT) AS n_tokens, CAST({n} AS INTEGER) AS seq_len, '{tok}' AS tokenizer,
        CAST({eos} AS INTEGER) AS eos_id FROM ({samples}) s"""
        for split, tok, n, eos, samples in (
            ("train", "words", SEQ_LEN, WORD_VOCAB, SAMPLES),
            ("val", "bytes", 512, BYTES_EOS, packed(BYTES_EOS_SQL, 512)),
        )
    ),
    "ensure_namespace": "SELECT lang, count(*) AS n FROM documents GROUP BY lang",
    "write_indexed": f"""SELECT doc_ord, tok_offset, n_tokens, {text_of('ids')} AS tokens
        FROM ({offsets(WORDS_EOS)}) o""",
    "write_pairs": f"SELECT *, 'train' AS split FROM ({PAIRS}) p",
    "manifest": in_splits(
        f"""SELECT count(*) AS n_samples, CAST(sum(len(ids)) AS BIGINT) AS n_tokens,
        CAST({SEQ_LEN} AS INTEGER) AS seq_len, 'words' AS tokenizer,
        CAST({WORD_VOCAB} AS INTEGER) AS eos_id, true AS has_shards FROM ({SAMPLES}) s"""
    ),
    "tokenize_words": tokens_out(WORDS),
    "tokenize_bytes": tokens_out(BYTES),
    "tokenize_bpe": tokens_out(bpe(eos=False)),
    "tokenize_pieces": tokens_out(pieces()),
    "append_eos_text": tokens_out(WORDS_EOS_TEXT),
    "append_eos_id": tokens_out(WORDS_EOS),
    "append_eod": tokens_out(BYTES_EOS_SQL),
    "raw_text_corpus": "SELECT doc_id, text FROM documents",
    "format_instructions": PAIRS,
    "preprocessor_by_path": PAIRS,
    "preprocessor_by_row": f"""SELECT sample_id, context || '|' || instruction AS prompt, response
        FROM ({RECORDS}) r""",
    "decoder_only": arrays_out(pair_arrays(None)),
    "truncate": arrays_out(pair_arrays(PAIR_LEN)),
    "pad_full": arrays_out(pair_arrays(PAIR_LEN), WORD_VOCAB),
    "pad_longest": arrays_out(
        f"""SELECT *, max(len(input_ids)) OVER (PARTITION BY batch) AS longest
        FROM (SELECT *, CAST((row_number() OVER (ORDER BY sample_id) - 1) // 16 AS BIGINT) AS batch
              FROM ({pair_arrays(PAIR_LEN)}) x) y""",
        0,
        "longest",
        ", batch",
    ),
    "duration_batches": """SELECT doc_id, n_chars || ['ba', 'ep', 'tok'][doc_id % 3 + 1] AS duration,
        CASE doc_id % 3 WHEN 0 THEN n_chars WHEN 1 THEN n_chars * 31 END AS batches FROM documents""",
    "keep_splits": f"""SELECT subset, split, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids
        FROM ({SUBSETS}) s WHERE split = 'val_small' GROUP BY subset, split""",
    "keep_subset": f"SELECT doc_id, subset, split FROM ({SUBSETS}) s WHERE subset = 'fr'",
    "token_offsets": f"""SELECT doc_id, doc_ord, tok_offset, n_tokens, n_docs
        FROM ({offsets(WORDS_EOS)}) o""",
    "pack_samples": samples_out(SAMPLES),
    "read_by_index": samples_out(SAMPLES),
    "feistel_epochs": FEISTEL,
    "content_seals": in_splits(f"""SELECT count(*) AS n_rows, CAST(sum(CAST('0x' || substr(md5(concat_ws(chr(1), len(ids), sample_id,
      CAST(ids AS VARCHAR))), 1, 15) AS HUGEINT)) AS VARCHAR) AS seal FROM ({SAMPLES}) s"""),
    "sample_index": f"""WITH o AS ({offsets(WORDS_EOS)}),
      s AS (SELECT unnest(range((SELECT CAST(sum(n_tokens) AS BIGINT) // {SEQ_LEN} FROM o))) AS sample_id)
    SELECT sample_id, a.doc_ord AS first_doc, sample_id * {SEQ_LEN} - a.tok_offset AS first_offset,
      b.doc_ord AS last_doc, (sample_id + 1) * {SEQ_LEN} - b.tok_offset AS last_end
    FROM s JOIN o a ON sample_id * {SEQ_LEN} >= a.tok_offset AND sample_id * {SEQ_LEN} < a.tok_offset + a.n_tokens
    JOIN o b ON (sample_id + 1) * {SEQ_LEN} > b.tok_offset AND (sample_id + 1) * {SEQ_LEN} <= b.tok_offset + b.n_tokens""",
    "pack_keep_tail": samples_out(packed(WORDS_EOS_TEXT, 1000, keep_tail=True)),
    "pack_bytes": f"""SELECT sample_id, CAST(len(ids) AS INTEGER) AS n_tokens,
        CAST(list_sum(list_transform(ids, lambda x, i: CAST(x AS BIGINT) * i)) AS BIGINT) AS weighed_sum,
        ids[1] AS first_token
        FROM ({packed(BYTES_EOS_SQL)}) s""",
    "shuffle_epochs": """SELECT doc_id, CAST(e AS INTEGER) AS epoch, CAST(row_number() OVER (PARTITION BY e
        ORDER BY md5('17:' || e || ':' || doc_id), doc_id) - 1 AS BIGINT) AS rank
        FROM (SELECT doc_id, unnest(range(3)) AS e FROM documents) d""",
    "ordered_rank": """SELECT event_id, user_id,
        CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS rank FROM events""",
    "rank_in_run": f"SELECT user_id, event_id, rank FROM ({EVENT_RANKS}) e",
    "split_weighted": f"""SELECT doc_id, doc_ord, {weighted('doc_ord', 'n')} AS split
        FROM (SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS doc_ord,
              count(*) OVER () AS n FROM documents) d""",
    "split_copy": in_splits("SELECT doc_id, lang FROM documents"),
    "assign_batches": f"SELECT sample_id, rank, CAST(rank // 64 AS BIGINT) AS batch FROM ({RANKED_IDS}) r",
    "drop_last": f"""SELECT sample_id, rank, CAST(rank // 100 AS BIGINT) AS batch FROM ({RANKED_IDS}) r
        WHERE rank // 100 < n // 100""",
    "assign_devices": f"""SELECT sample_id, epoch, rank, {device_cols(48, 8, 4)}
        FROM (SELECT sample_id, CAST(0 AS INTEGER) AS epoch, CAST(row_number() OVER (
              ORDER BY md5('17:0:' || sample_id), sample_id) - 1 AS BIGINT) AS rank
              FROM ({SAMPLES}) s) r""",
    "epoch_plan": plan(SAMPLE_IDS, PRETRAIN),
    "batch_limited_plan": plan(SAMPLE_IDS, PRETRAIN, limit="40"),
    "unshuffled_epochs": plan(
        SAMPLE_IDS, type(PRETRAIN)(global_batch=64, max_duration="2ep", drop_last=False), shuffle=False
    ),
    "plan_markers": f"""SELECT sample_id, epoch, global_batch, {marker_cols(5, 10, True)}
        FROM ({plan(SAMPLE_IDS, PRETRAIN)}) p""",
    "eval_subset": f"""SELECT sample_id, rank, CAST(rank // 8 AS BIGINT) AS batch FROM ({RANKED_IDS}) r
        WHERE rank // 8 < 7""",
    "plan_stats": f"""SELECT epoch, batch, count(*) AS n_rows, CAST(sum(used) AS BIGINT) AS n_tokens,
        count(*) * {PAIR_LEN} AS n_positions,
        CAST(sum({PAIR_LEN} - used) AS BIGINT) AS n_padding FROM ({FT_ROWS}) r GROUP BY epoch, batch""",
    "run_totals": f"""SELECT count(*) AS n_rows, CAST(sum(used) AS BIGINT) AS n_tokens,
        count(*) * {PAIR_LEN} AS n_positions, CAST(sum({PAIR_LEN} - used) AS BIGINT) AS n_padding,
        sum({PAIR_LEN} - used)::DOUBLE / (count(*) * {PAIR_LEN})::DOUBLE AS padding_share
        FROM ({FT_ROWS}) r""",
    "parse_metrics": f"""SELECT
        CASE WHEN NOT is_note THEN run_id END AS run_id, CASE WHEN NOT is_note THEN batch END AS batch,
        CASE WHEN NOT is_note THEN device END AS device, CASE WHEN NOT is_note THEN tokens END AS tokens,
        CASE WHEN NOT is_note THEN loss END AS loss, CASE WHEN NOT is_note THEN lr END AS lr,
        CASE WHEN NOT is_note THEN mem_bytes END AS mem_bytes,
        CASE WHEN is_note THEN note END AS text,
        CASE WHEN NOT is_note THEN epoch_us(ts) END AS ts_us FROM ({LINES}) l""",
    "rolling_speed": SPEED,
    "lr_series": LR,
    "memory_peak": MEMORY,
    "eta": ETA,
    "console_interval": f"SELECT * FROM ({MEMORY}) m WHERE batch % 5 = 0",
    "follow_metrics": f"""SELECT run_id, epoch_us(start) AS window_us, count(*) AS n_lines,
        CAST(sum(tokens) AS BIGINT) AS tokens, max(mem_bytes) AS peak_bytes, max(batch) AS last_batch
        FROM (SELECT *, time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS start
              FROM ({METRICS}) m) w GROUP BY run_id, start""",
    "follow_rolling": SPEED,
    "rolling_in_state": SPEED,
    "stop_following": "SELECT count(*) AS n_lines, false AS active FROM events",
    "jsonl_to_shards": in_splits(samples_out(packed(WORDS_EOS_TEXT))),
    "text_to_shards": samples_out(SAMPLES, ", 'train' AS split"),
    "text_blocks_to_shards": samples_out(packed(FILES), ", 'train' AS split"),
    "dataset_to_shards": by_split("split"),
    "instructions_to_pairs": f"SELECT *, 'train' AS split FROM ({PAIRS}) p",
    "jsonl_to_indexed": f"""SELECT doc_ord, tok_offset, n_tokens, {text_of('ids')} AS tokens,
        {weighted('doc_ord', 'n_docs')} AS split FROM ({offsets(bpe(eos=True))}) o""",
    "training_plan": full_plan(SAMPLE_IDS, PRETRAIN),
    "finetune_plan": f"""SELECT epoch, global_batch, batch, device, micro, pos, sample_id, is_eval, is_save,
        CAST(used AS INTEGER) AS n_tokens, {text_of(padded('input_ids', WORD_VOCAB, str(PAIR_LEN)))} AS input_ids,
        {text_of(padded('labels', IGNORE_LABEL, str(PAIR_LEN)))} AS labels,
        {text_of(padded('attention_mask', 0, str(PAIR_LEN)))} AS attention_mask FROM ({FT_ROWS}) r""",
    "run_metrics": f"""SELECT e.*, l.lr, m.peak_bytes FROM ({ETA}) e
        JOIN ({LR}) l USING (run_id, batch) JOIN ({MEMORY}) m USING (run_id, batch)""",
    "jsonl_no_id_to_shards": in_splits(samples_out(packed(WORDS_EOS_TEXT))),
    "jsonl_no_id_to_indexed": f"""SELECT doc_ord, tok_offset, n_tokens, {text_of('ids')} AS tokens,
        {weighted('doc_ord', 'n_docs')} AS split FROM ({offsets(bpe(eos=True))}) o""",
    "jsonl_to_raw_shards": "SELECT doc_id, text, 'val' AS split FROM documents",
    "evaluation_plan_devices": f"""SELECT CAST(rank // 24 AS BIGINT) AS batch, {device_cols(24, 4, 2)}, sample_id
        FROM ({RANKED_IDS}) r""",
    "eval_every_epoch": f"""SELECT epoch, global_batch, batch, {device_cols(64, 8, 2)}, sample_id,
        (global_batch + 1) % (n // 64) = 0 AS is_eval, (global_batch + 1) % 12 = 0 AS is_save
        FROM ({plan(SAMPLE_IDS, PRETRAIN)}) b, (SELECT count(*) AS n FROM ({SAMPLE_IDS}) s) c""",
    "finetune_from_shards": ft_out(FT_COLUMNS, FT_ROWS, str(PAIR_LEN)),
    "finetune_trimmed": ft_out(
        FT_COLUMNS, f"SELECT *, max(used) OVER (PARTITION BY epoch, batch) AS longest FROM ({FT_ROWS}) t", "longest"
    ),
    "finetune_evaluation_plan": ft_out(
        "batch, device, micro, pos, sample_id",
        f"""SELECT CAST(rank // 12 AS BIGINT) AS batch, {device_cols(12, 4, 2)}, a.*, len(input_ids) AS used
        FROM (SELECT sample_id, row_number() OVER (ORDER BY sample_id) - 1 AS rank FROM ({PAIRS}) p) r
        JOIN ({pair_arrays(PAIR_LEN)}) a USING (sample_id)""",
        str(PAIR_LEN),
    ),
}

"""DuckDB SQL for the catalog's queries, written independently of the Spark code.

Training is spelled out as one set of CTEs per merge on bracketed hex (``<74><68>``), so
nothing learned by Spark enters the SQL.
"""

from __future__ import annotations

MERGES = 24
MORE_MERGES = 300
COMPLETION_STEPS = 50
SEQ_LEN = 512

# The Unicode White_Space code points as a regex class.
WS = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
TEXT_COLUMNS = {
    "documents": ("text", "lang", "source"),
    "conversations": ("role", "text"),
    "pages": ("url", "html"),
    "benchmark": ("text",),
}
EDGES = (0, 100, 500, 1000, 5000, 10000, 50000)


def words(column: str) -> str:
    return f"list_filter(regexp_split_to_array({column}, '{WS}+'), lambda x: x <> '')"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def frequency(table: str = "documents", column: str = "text") -> str:
    return (
        f"SELECT word, count(*) AS freq FROM (SELECT unnest({words(column)}) AS word FROM {table}) "
        "GROUP BY word"
    )


WORD_FREQ = f"wf AS MATERIALIZED ({frequency()})"
# Words of the benchmark texts that no document has take part with a count of 0.
WORD_FREQ_WITH_PROMPTS = f"""wf AS MATERIALIZED (
    SELECT word, sum(freq)::BIGINT AS freq FROM ({frequency()}
    UNION ALL SELECT DISTINCT unnest({words('text')}), 0 FROM benchmark) GROUP BY word)"""
HEXED = r"regexp_replace(lower(hex(encode(word))), '(..)', '<\1>', 'g')"


def training(n: int = MERGES) -> list[str]:
    """CTEs from ``wf(word, freq)`` to ``merges`` and ``encoded(word, freq, s)``."""
    ctes = [f"s0 AS MATERIALIZED (SELECT word, freq, {HEXED} AS s FROM wf)"]
    for i in range(n):
        ctes.append(
            f"""b{i} AS MATERIALIZED (
    SELECT z[1] AS l, z[2] AS r, sum(freq)::BIGINT AS f FROM (
        SELECT freq, unnest(list_zip(a[:-2], a[2:])) AS z FROM (
            SELECT freq, string_split(s[2:-2], '><') AS a FROM s{i} WHERE contains(s, '><')))
    GROUP BY l, r ORDER BY f DESC, l, r LIMIT 1)"""
        )
        ctes.append(
            f"""s{i + 1} AS MATERIALIZED (
    SELECT word, freq, replace(s, '<' || l || '><' || r || '>', '<' || l || r || '>') AS s
    FROM s{i}, b{i})"""
        )
    rows = "\n    UNION ALL ".join(
        f"SELECT {i} AS rank, l, r, l || r AS merged, {260 + i} AS id, f FROM b{i}" for i in range(n)
    )
    ctes.append(f"merges AS MATERIALIZED ({rows})")
    ctes.append(f"encoded AS (SELECT word, freq, s FROM s{n})")
    return ctes


TOKEN_ID = "CASE WHEN length(h) = 2 THEN 4 + ('0x' || h)::INT ELSE m.id END"
# dict(word, freq, ids INT[])
DICT = f"""dict AS MATERIALIZED (
    SELECT word, any_value(freq) AS freq, list({TOKEN_ID} ORDER BY p) AS ids FROM (
        SELECT word, freq, unnest(a) AS h, generate_subscripts(a, 1) AS p
        FROM (SELECT word, freq, string_split(s[2:-2], '><') AS a FROM encoded))
    LEFT JOIN merges m ON m.merged = h GROUP BY word)"""


def encoded_texts(table: str = "documents", key: str = "doc_id", name: str = "enc") -> str:
    """``name(key, text, ids)``: ids of each text, words joined by 36."""
    return f"""{name} AS MATERIALIZED (
    SELECT d.{key}, d.text, coalesce(e.ids, []::INT[]) AS ids FROM {table} d LEFT JOIN (
        SELECT {key}, flatten(list(CASE WHEN p = 1 THEN ids ELSE [36] || ids END ORDER BY p)) AS ids
        FROM (SELECT {key}, unnest(ws) AS word, generate_subscripts(ws, 1) AS p
              FROM (SELECT {key}, {words('text')} AS ws FROM {table})) JOIN dict USING (word)
        GROUP BY {key}) e USING ({key}) WHERE d.text IS NOT NULL)"""


TOKENS = "tok AS MATERIALIZED (SELECT doc_id, [2] || ids || [3] AS ids FROM enc)"


def with_tokens(*more: str) -> str:
    return with_(WORD_FREQ, *training(), DICT, encoded_texts(), TOKENS, *more)


def joined(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


def profile(table: str) -> str:
    parts = []
    for column in TEXT_COLUMNS[table]:
        metrics = {
            "rows": "count(*)",
            "nulls": "count(*) - count(c)",
            "null_pct": "(count(*) - count(c))::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE",
            "n": "count(c)",
            "chars_min": "min(c)",
            "chars_max": "max(c)",
            "chars_mean": "avg(c)",
            "chars_median": "(list(c ORDER BY c) FILTER (c IS NOT NULL))[count(c) // 2 + 1]",
            "words_min": "min(w)",
            "words_max": "max(w)",
            "words_mean": "avg(w)",
            "words_median": "(list(w ORDER BY w) FILTER (w IS NOT NULL))[count(w) // 2 + 1]",
            "graphemes_mean": "avg(g)",
        }
        source = (
            f"(SELECT length({column}) AS c, len({words(column)}) AS w, "
            f"length_grapheme({column}) AS g FROM {table})"
        )
        parts += [
            f"SELECT '{column}' AS \"column\", '{name}' AS metric, ({value})::DOUBLE AS value FROM {source}"
            for name, value in metrics.items()
        ]
    return "\nUNION ALL ".join(parts)


def null_counts(*tables: str) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", count(*) AS n_rows,
        count(*) - count({c}) AS nulls,
        (count(*) - count({c}))::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE AS null_pct FROM {t}"""
        for t in tables
        for c in TEXT_COLUMNS[t]
    )


def char_counts(table: str, column: str, rows: str = "") -> str:
    source = f"(SELECT {column} FROM {table} {rows})" if rows else table
    return f"""SELECT '{column}' AS "column", char, count(*) AS freq,
        row_number() OVER (ORDER BY count(*) DESC, char)::INT AS rank
    FROM (SELECT unnest(string_split({column}, '')) AS char FROM {source}) WHERE char <> ''
    GROUP BY char"""


def top_chars(inner: str) -> str:
    return f"""SELECT "column", rank, char,
        CASE WHEN regexp_matches(char, '{WS}') THEN '[space:U+' || to_hex(unicode(char)) || ']'
        ELSE char END AS label, freq FROM ({inner}) WHERE rank <= 20"""


def histogram(table: str, column: str) -> str:
    edges = ", ".join(
        f"({lo}, {'NULL' if hi is None else hi})" for lo, hi in zip(EDGES, (*EDGES[1:], None))
    )
    return f"""SELECT '{column}' AS "column", lo::BIGINT AS lo, hi::BIGINT AS hi, count(len) AS n,
        count(len)::DOUBLE / any_value(total)::DOUBLE * 100.0::DOUBLE AS pct
    FROM (VALUES {edges}) e(lo, hi)
    LEFT JOIN (SELECT length({column}) AS len FROM {table}) ON len >= lo AND (hi IS NULL OR len < hi)
    CROSS JOIN (SELECT count({column}) AS total FROM {table}) GROUP BY lo, hi"""


PREVIEW = """CASE WHEN octet_length(encode({c})) > 500 THEN left({c}, 500) || '...' ELSE {c} END"""


def samples(table: str, key: str) -> str:
    return "\nUNION ALL ".join(
        f"""(SELECT '{c}' AS "column", {key}, {PREVIEW.format(c=c)} AS preview FROM {table}
        WHERE {c} IS NOT NULL ORDER BY {key} LIMIT 3)"""
        for c in TEXT_COLUMNS[table]
    )


OCCURRENCES = f"""occ AS (SELECT doc_id, (generate_subscripts(ws, 1) - 1)::INT AS pos,
    unnest(ws) AS word FROM (SELECT doc_id, {words('text')} AS ws FROM documents))"""

PAIRS = f"""hexed AS (SELECT freq, string_split(s[2:-2], '><') AS a FROM (
        SELECT freq, {HEXED} AS s FROM wf) WHERE contains(s, '><')),
    pairs AS MATERIALIZED (SELECT z[1] AS "left", z[2] AS "right", sum(freq)::BIGINT AS freq
        FROM (SELECT freq, unnest(list_zip(a[:-2], a[2:])) AS z FROM hexed) GROUP BY ALL)"""

# Rank of each document in the seeded shuffle, and the exact split.
SPLIT = """ranked AS MATERIALIZED (SELECT doc_id, rn,
        CASE WHEN rn <= floor(count(*) OVER () * 0.9::DOUBLE) THEN 'train' ELSE 'valid' END AS split
    FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn
          FROM documents WHERE text IS NOT NULL))"""


def batch_rows(split: str, order: str, epoch: str) -> str:
    return f"""batch AS MATERIALIZED (SELECT {epoch}::INT AS epoch, ((rn - 1) // 16)::BIGINT AS batch_id,
        ((rn - 1) % 16)::INT AS row_in_batch, doc_id, w AS window_no,
        p[1:{SEQ_LEN}] AS input, p[2:{SEQ_LEN + 1}] AS target
    FROM (SELECT doc_id, w, row_number() OVER (ORDER BY {order}, doc_id, w) AS rn,
            list_resize(ids[w * {SEQ_LEN} + 1:w * {SEQ_LEN} + {SEQ_LEN + 1}], {SEQ_LEN + 1}, 0) AS p
          FROM (SELECT doc_id, ids, unnest(range(0, greatest(ceil((len(ids) - 1) / {SEQ_LEN}), 1)::INT))::INT AS w
                FROM tok) JOIN ranked USING (doc_id) WHERE split = '{split}'))"""


PAIR_ROWS = """steps AS MATERIALIZED (SELECT doc_id, (p - 1)::INT AS pos, t[p] AS input, t[p + 1] AS target
    FROM (SELECT doc_id, t, unnest(range(1, len(t))) AS p
          FROM (SELECT doc_id, ids AS t FROM tok)))"""
COUNTS = """counts AS MATERIALIZED (
    SELECT ids[p] AS context, ids[p + 1] AS next, count(*) AS freq
    FROM (SELECT ids, unnest(range(1, len(ids))) AS p FROM tok) GROUP BY ALL)"""
BEST = """best AS MATERIALIZED (SELECT context, next FROM counts
    QUALIFY row_number() OVER (PARTITION BY context ORDER BY freq DESC, next) = 1)"""


TRIMMED = f"regexp_replace(text, '^{WS}+|{WS}+$', '', 'g')"


def completions(steps: int = COMPLETION_STEPS) -> str:
    walk = [
        "c0 AS (SELECT item_id, text, ([2] || ids)[-1] AS last, []::INT[] AS ids "
        f"FROM penc WHERE len({words('text')}) > 0)"
    ]
    for i in range(steps):
        walk.append(
            f"""c{i + 1} AS (SELECT item_id, text, next AS last,
        CASE WHEN next IS NULL THEN ids ELSE ids || [next] END AS ids
    FROM c{i} LEFT JOIN best ON context = last)"""
        )
    token_hex = """CASE WHEN t = 1 THEN hex(encode('<UNK>')) WHEN t < 4 THEN ''
        WHEN t < 260 THEN printf('%02x', t - 4) ELSE m.merged END"""
    return (
        with_(
            WORD_FREQ_WITH_PROMPTS,
            *training(),
            DICT,
            encoded_texts(),
            encoded_texts("benchmark", "item_id", "penc"),
            TOKENS,
            COUNTS,
            BEST,
            *walk,
            f"""bytes AS (SELECT item_id, string_agg({token_hex}, '' ORDER BY p) AS x FROM (
        SELECT item_id, unnest(ids) AS t, generate_subscripts(ids, 1) AS p FROM c{steps})
        LEFT JOIN merges m ON m.id = t GROUP BY item_id)""",
        )
        + f"""SELECT item_id, {TRIMMED} AS prompt, {joined('ids')} AS new_ids,
        lower(hex(encode({TRIMMED}))) || lower(coalesce(x, '')) AS completion_hex
    FROM c{steps} LEFT JOIN bytes USING (item_id)"""
    )


LOSS_TERM = """CASE WHEN label <> 0 THEN (
    ln(list_sum(list_transform(x, lambda v: exp(v - list_max(x))))) + list_max(x) - x[label + 1]
    )::DECIMAL(30, 12) END"""
LOSS = f"""terms AS (SELECT vec_id, label, {LOSS_TERM} AS term
    FROM (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings))"""
LOSS_COLUMNS = """count(*) AS n_all, count(*) FILTER (label <> 0) AS n_nonpad,
    round(coalesce(sum(term), 0)::DOUBLE / nullif(count(*) FILTER (label <> 0), 0), 6) AS loss_nonpad,
    round(coalesce(sum(term), 0)::DOUBLE / count(*), 6) AS loss_all"""


# Prompts, their places (id and next id), and the stand-in model's scores after each id.
SCORED = (
    WORD_FREQ_WITH_PROMPTS,
    *training(),
    DICT,
    encoded_texts("benchmark", "item_id", "penc"),
    """places AS (SELECT item_id, ids[p] AS x, ids[p + 1] AS y FROM (
        SELECT item_id, ids, unnest(range(1, len(ids))) AS p FROM (
            SELECT item_id, [2] || ids || [3] AS ids FROM penc)))""",
    f"""scores AS MATERIALIZED (SELECT t, list_transform(range({260 + MERGES}),
        lambda j: ((31 * t + 17 * j) % 101)::DOUBLE / 10.0::DOUBLE) AS s FROM range({260 + MERGES}) r(t))""",
)

# Well-formed UTF-8 in hex, and the longest beginnings of it that are cut short.
_TAIL = "[89ab]."
UTF8_GOOD = "|".join(
    (
        "[0-7].",
        f"(?:c[2-9a-f]|d.){_TAIL}",
        f"e0[ab].{_TAIL}",
        f"e[1-9abcef]{_TAIL}{_TAIL}",
        f"ed[89].{_TAIL}",
        f"f0[9ab].{_TAIL}{_TAIL}",
        f"f[1-3]{_TAIL}{_TAIL}{_TAIL}",
        f"f48.{_TAIL}{_TAIL}",
    )
)
UTF8_PIECES = UTF8_GOOD + "|" + "|".join(
    (
        "e0[ab].",
        f"e[1-9abcef]{_TAIL}",
        "ed[89].",
        f"f0[9ab].(?:{_TAIL})?",
        f"f[1-3]{_TAIL}(?:{_TAIL})?",
        f"f48.(?:{_TAIL})?",
        "..",
    )
)


def token_hex(merges: str, token: str) -> str:
    return f"""(CASE WHEN {token} = 1 THEN lower(hex(encode('<UNK>'))) WHEN {token} < 4 THEN ''
        WHEN {token} < 260 THEN printf('%02x', ({token} - 4)::INT) ELSE {merges}.merged END)"""


def statements() -> dict[str, str]:
    merge_list = with_(WORD_FREQ, *training())
    merges_out = """SELECT rank, l AS "left", r AS "right", merged, id, f AS freq FROM merges"""
    text_encoding = with_(WORD_FREQ, *training(), DICT, encoded_texts())
    prompt_encoding = with_(
        WORD_FREQ_WITH_PROMPTS, *training(), DICT, encoded_texts("benchmark", "item_id", "penc")
    )
    vocabulary = """SELECT id, token, kind FROM (
        SELECT * FROM (VALUES (0, '<PAD>'), (1, '<UNK>'), (2, '<BOS>'), (3, '<EOS>')) s(id, t),
            LATERAL (SELECT lower(hex(encode(t))) AS token, 'special' AS kind)
        UNION ALL SELECT (4 + b)::INT, '', printf('%02x', b), 'byte' FROM range(256) x(b)
        UNION ALL SELECT id, '', merged, 'merge' FROM merges)"""
    running = ",\n".join(
        f"count(*) FILTER (c >= {lo}{'' if hi is None else f' AND c < {hi}'}) AS chars_from_{lo}"
        for lo, hi in zip(EDGES, (*EDGES[1:], None))
    )
    framed = f"""SELECT doc_id, {joined('ids')} AS token_ids, len(ids)::INT AS n_tokens FROM tok"""
    word_count = frequency()
    return {
        # scans and profile
        "schema_summary": """SELECT (ordinal_position - 1)::INT AS ordinal, column_name AS name,
            CASE data_type WHEN 'VARCHAR' THEN 'string' ELSE lower(data_type) END AS type,
            (SELECT count(*) FROM documents) AS n_rows
            FROM information_schema.columns WHERE table_name = 'documents'""",
        "profile_documents": profile("documents"),
        "profile_conversations": profile("conversations"),
        "profile_pages": profile("pages"),
        "null_counts": null_counts("documents", "conversations", "pages", "benchmark"),
        "text_measures": f"""SELECT doc_id, length(text)::INT AS chars, len({words('text')})::INT AS words,
            length_grapheme(text)::INT AS graphemes FROM documents WHERE text IS NOT NULL""",
        "char_frequency": char_counts("documents", "text"),
        "top_chars": "\nUNION ALL ".join(
            top_chars(char_counts("documents", c)) for c in TEXT_COLUMNS["documents"]
        ),
        "char_frequency_first_rows": char_counts("documents", "text", "ORDER BY doc_id LIMIT 50"),
        "length_histogram": "\nUNION ALL ".join(
            histogram("documents", c) for c in TEXT_COLUMNS["documents"]
        ),
        "sample_texts": samples("documents", "doc_id"),
        "previews": f"SELECT page_id, {PREVIEW.format(c='html')} AS preview FROM pages",
        # words and pairs
        "word_positions": with_(OCCURRENCES) + "SELECT * FROM occ",
        "word_frequency": word_count,
        "corpus_totals": f"""SELECT count(*) AS unique_words, sum(freq)::BIGINT AS total_words,
            sum(freq * octet_length(encode(word)))::BIGINT AS total_bytes FROM ({word_count})""",
        "byte_symbols": f"""SELECT word, lower(hex(encode(word))) AS hex,
            array_to_string(list_transform(regexp_extract_all(hex(encode(word)), '..'),
                lambda h: 4 + ('0x' || h)::INT), ' ') AS ids FROM ({word_count})""",
        "hex_round_trip": f"""SELECT word, lower(hex(encode(word))) AS hex, word AS back
            FROM ({word_count})""",
        "adjacent_symbols": f"""{with_(WORD_FREQ)}SELECT word, (i - 1)::INT AS pos,
            a[i] AS "left", a[i + 1] AS "right" FROM (
            SELECT word, a, unnest(range(1, len(a))) AS i FROM (SELECT word,
                list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda h: lower(h)) AS a FROM wf))""",
        "pair_frequency": with_(WORD_FREQ, PAIRS) + 'SELECT "left", "right", freq FROM pairs',
        "best_pair": with_(WORD_FREQ, PAIRS)
        + 'SELECT "left", "right", freq FROM pairs ORDER BY freq DESC, "left", "right" LIMIT 1',
        "first_merge": with_(WORD_FREQ, *training(1), DICT)
        + f"SELECT word, freq, {joined('ids')} AS token_ids FROM dict",
        # training
        "train_merges": merge_list + merges_out,
        "train_more_merges": with_(WORD_FREQ, *training(MORE_MERGES)) + merges_out,
        "train_from_chunks": with_(
            f"""wf AS MATERIALIZED (SELECT word, sum(freq)::BIGINT AS freq FROM ({frequency()}
            UNION ALL {frequency('conversations')}) GROUP BY word)""",
            *training(),
        )
        + merges_out,
        "merge_progress": merge_list
        + """SELECT rank, l AS "left", r AS "right", merged, id, f AS freq, id + 1 AS vocab_size
            FROM merges WHERE (rank + 1) % 8 = 0""",
        "vocabulary": merge_list + vocabulary,
        "vocabulary_size": merge_list
        + f"SELECT count(DISTINCT token) AS vocab_size FROM ({vocabulary})",
        "tokenizer_file": merge_list
        + """SELECT rank, l AS "left", r AS "right", 10000 AS vocab_size FROM merges""",
        # encode and decode
        "word_token_ids": with_(WORD_FREQ, *training(), DICT)
        + f"SELECT word, freq, {joined('ids')} AS token_ids FROM dict",
        "occurrence_ids": with_(WORD_FREQ, *training(), DICT, OCCURRENCES)
        + f"""SELECT doc_id, pos, word, {joined('ids')} AS token_ids FROM occ JOIN dict USING (word)""",
        "encode_documents": text_encoding
        + f"SELECT doc_id, {joined('ids')} AS token_ids, len(ids)::INT AS n_tokens FROM enc",
        "encode_large_vocabulary": with_(
            WORD_FREQ, *training(MORE_MERGES), DICT, encoded_texts(), TOKENS
        )
        + framed,
        "encode_prompts": prompt_encoding
        + f"SELECT item_id, {joined('[2] || ids')} AS token_ids FROM penc",
        "token_rows": with_tokens() + framed,
        "token_table": with_tokens() + framed,
        "token_store": with_tokens() + framed,
        "decode_documents": f"SELECT doc_id, array_to_string({words('text')}, ' ') AS decoded FROM documents",
        "round_trip": prompt_encoding
        + f"""SELECT item_id, text, {joined('ids')} AS token_ids, len(ids)::INT AS n_tokens,
            array_to_string({words('text')}, ' ') AS decoded FROM penc""",
        "token_strings": with_tokens(
            f"used AS (SELECT t, count(*) AS freq FROM (SELECT unnest(ids || [t_max + 1]) AS t "
            f"FROM tok, (SELECT {260 + MERGES} AS t_max)) GROUP BY t)"
        )
        + """SELECT t::INT AS id, freq, CASE WHEN t = 2 THEN '<BOS>' WHEN t = 3 THEN '<EOS>'
            WHEN t < 132 THEN chr((t - 4)::INT) WHEN t < 260 THEN chr(65533)
            WHEN m.merged IS NULL THEN '<INVALID>' ELSE decode(unhex(m.merged)) END AS token
            FROM used LEFT JOIN merges m ON m.id = t""",
        # samples, split, batches
        "shuffled_order": with_(SPLIT) + "SELECT doc_id, rn FROM ranked",
        "train_valid_split": with_(SPLIT) + "SELECT doc_id, split FROM ranked",
        "sample_at_index": """SELECT doc_id, text, sample_idx FROM (SELECT doc_id, text,
            row_number() OVER (ORDER BY doc_id) - 1 AS sample_idx FROM documents) WHERE sample_idx = 137""",
        "sample_index": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents",
        "train_batches": with_tokens(SPLIT, batch_rows("train", "md5('42:1:' || doc_id || ':' || w)", "1"))
        + f"""SELECT epoch, batch_id, row_in_batch, doc_id, window_no, {joined('input')} AS input,
            {joined('target')} AS target FROM batch""",
        "valid_batches": with_tokens(SPLIT, batch_rows("valid", "md5('42:' || doc_id || ':' || w)", "NULL"))
        + f"""SELECT epoch, batch_id, row_in_batch, doc_id, window_no, {joined('input')} AS input,
            {joined('target')} AS target FROM batch""",
        "stacked_batches": with_tokens(SPLIT, batch_rows("train", "md5('42:1:' || doc_id || ':' || w)", "1"))
        + f"""SELECT epoch, batch_id, count(*)::INT AS n_rows,
            string_agg({joined('input')}, '|' ORDER BY row_in_batch) AS inputs,
            string_agg({joined('target')}, '|' ORDER BY row_in_batch) AS targets
            FROM batch GROUP BY epoch, batch_id""",
        "next_token_pairs": with_tokens(PAIR_ROWS) + "SELECT * FROM steps",
        # scoring
        "next_token_counts": with_tokens(COUNTS)
        + "SELECT context::VARCHAR AS context, next, freq FROM counts",
        "next_token_counts_2": with_tokens()
        + """SELECT ids[p] || ' ' || ids[p + 1] AS context, ids[p + 2] AS next, count(*) AS freq
            FROM (SELECT ids, unnest(range(1, len(ids) - 1)) AS p FROM tok) GROUP BY ALL""",
        "best_next_token": with_tokens(COUNTS, BEST)
        + "SELECT context::VARCHAR AS context, next FROM best",
        "complete_prompts": completions(),
        "blank_texts_skipped": f"""SELECT conv_id, turn, text FROM conversations
            WHERE len({words('text')}) > 0""",
        "masked_loss": with_(LOSS) + f"SELECT {LOSS_COLUMNS} FROM terms",
        "loss_by_split": with_(
            LOSS,
            """parts AS (SELECT vec_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || vec_id), vec_id)
                <= floor(count(*) OVER () * 0.9::DOUBLE) THEN 'train' ELSE 'valid' END AS split
                FROM embeddings)""",
        )
        + f"SELECT split, {LOSS_COLUMNS} FROM terms JOIN parts USING (vec_id) GROUP BY split",
        "loss_by_epoch": with_(LOSS)
        + f"SELECT (vec_id % 3)::INT AS epoch, {LOSS_COLUMNS} FROM terms GROUP BY ALL",
        "scorer_loss": with_(
            *SCORED,
            """terms AS (SELECT item_id, y AS label, CASE WHEN y <> 0 THEN
                (ln(list_sum(list_transform(s, lambda v: exp(v - list_max(s))))) + list_max(s) - s[y + 1]
                )::DECIMAL(30, 12) END AS term FROM (SELECT item_id, y, s FROM places JOIN scores ON x = t))""",
        )
        + f"SELECT item_id, {LOSS_COLUMNS} FROM terms GROUP BY item_id",
        "scorer_completion": with_(
            *SCORED,
            """best AS MATERIALIZED (SELECT t, list_position(s, list_max(s)) - 1 AS next FROM scores)""",
        ).replace("WITH ", "WITH RECURSIVE ", 1)
        + f""", walk AS (SELECT item_id, ([2] || ids)[-1] AS last, []::INT[] AS new_ids, 0 AS n FROM penc
            UNION ALL SELECT item_id, next, new_ids || [next::INT], n + 1 FROM walk JOIN best ON last = t
            WHERE n < {COMPLETION_STEPS})
            SELECT item_id, array_to_string(max_by(new_ids, n), ' ') AS new_ids FROM walk GROUP BY item_id""",
        "decode_with_unknown": f"""SELECT doc_id, array_to_string({words('text')}, ' ') || '<UNK>' AS decoded
            FROM documents""",
        "report_file": histogram("documents", "text")
        + "".join("\nUNION ALL " + histogram("documents", c) for c in TEXT_COLUMNS["documents"][1:]),
        "lossy_decode": with_tokens(PAIR_ROWS)
        + f"""SELECT input, target, freq, decode(unhex(array_to_string(list_transform(
                regexp_extract_all(h, '{UTF8_PIECES}'),
                lambda x: CASE WHEN regexp_full_match(x, '{UTF8_GOOD}') THEN x ELSE 'efbfbd' END), ''))) AS decoded
            FROM (SELECT input, target, freq, {token_hex('a', 'input')} || {token_hex('b', 'target')} AS h
                FROM (SELECT input, target, count(*) AS freq FROM steps GROUP BY ALL)
                LEFT JOIN merges a ON a.id = input LEFT JOIN merges b ON b.id = target)""",
        # streaming
        "stream_word_frequency": word_count,
        "stream_profile": f"""SELECT count(*) AS n_rows, count(*) - count(c) AS nulls,
            min(c)::INT AS chars_min, max(c)::INT AS chars_max, avg(c) AS chars_mean,
            min(w)::INT AS words_min, max(w)::INT AS words_max, avg(w) AS words_mean, {running}
            FROM (SELECT length(text) AS c, len({words('text')}) AS w FROM documents)""",
        "stream_tokens": with_tokens() + framed,
    }

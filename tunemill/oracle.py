"""SQL for DuckDB that computes what each query in ``queries.py`` computes.

Written by other means than the queries where there are any: windows in place
of joins, lists of lines in place of regular expressions, one global order in
place of buckets.
"""

from __future__ import annotations

from tunemill.queries import (
    BLOCK,
    COEFS,
    CONTEXT_HINT,
    EXPERTS,
    HINT,
    LABEL_NAMES,
    MAX_TOKENS,
    SAMPLE_ROWS,
    SEED,
    SIZE_LIMIT,
    WINDOW_CHARS,
)

BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
INDENT = r"[\t \x1f\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
WHITE = r"[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINE = "chr(10)"


def text(value: str) -> str:
    """A string literal; line breaks stand in it as they are."""
    return "'" + value.replace("'", "''") + "'"


def glue(*parts: str) -> str:
    return "(" + " || ".join(parts) + ")"


def as_lines(value: str) -> str:
    """The lines of a text; one final line break ends the last line."""
    even = f"regexp_replace({value}, '{BREAK}', {LINE}, 'g')"
    return rf"string_split(regexp_replace({even}, '\n\z', ''), {LINE})"


def stripped(lines: str) -> str:
    return f"array_to_string(list_transform({lines}, lambda x: regexp_replace(x, '^{INDENT}+', '')), {LINE})"


def normal(value: str) -> str:
    return stripped(as_lines(value))


def pretrain(value: str) -> str:
    filled = f"list_filter({as_lines(value)}, lambda x: NOT regexp_full_match(x, '{INDENT}*'))"
    return stripped(filled)


def user(*lines: str) -> str:
    inner = [part for line in lines for part in (line, LINE)]
    tail = text("<|im_end|>\n<|im_start|>assistant\n")
    return glue(text("<|im_start|>user\n"), *inner, tail)


def training(answer: str, *lines: str) -> str:
    return normal(glue(user(*lines), answer, text("\n<|im_end|>    ")))


def prompt(*lines: str) -> str:
    # Spaces in the last line keep the line break before them.
    return normal(glue(user(*lines), text("    ")))


def context_lines(hint: str, context: str, question: str) -> list[str]:
    return [hint, text("context:"), context, text("question:"), question]


def tokens(value: str) -> str:
    return f"list_filter(string_split_regex({value}, '{WHITE}+'), lambda x: x <> '')"


def digest(key: str) -> str:
    return f"md5('{SEED}:' || {key})"


PLACED = """
placed AS (
  SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS answer,
         lag(role) OVER w AS prev_role, lag(text) OVER w AS prev_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
), asked AS (
  SELECT conv_id, turn, text AS question, next_role, answer, prev_role, prev_text
  FROM placed WHERE role = 'user'
), pairs AS (SELECT * FROM asked WHERE next_role = 'assistant')
"""
CONTEXT = "coalesce(prev_text, '')"
QUALITY = (
    "CASE quality "
    + " ".join(f"WHEN {k} THEN {text(v)}" for k, v in LABEL_NAMES.items())
    + " ELSE CAST(quality AS VARCHAR) END"
)


def pair_text(expression: str) -> str:
    return f"WITH {PLACED} SELECT conv_id, turn, {expression} AS text FROM pairs"


def asked_prompt(expression: str) -> str:
    return f"WITH {PLACED} SELECT conv_id, turn, {expression} AS prompt FROM asked"


def ranked(source: str, key: str = "doc_id") -> str:
    """The rows of ``source`` with their place in the shuffled order."""
    return (
        f"SELECT *, row_number() OVER (ORDER BY {digest(key)}) AS place, count(*) OVER () AS total "
        f"FROM {source}"
    )


SIDE = "CASE WHEN place <= ceil(0.2 * total) THEN 'test' ELSE 'train' END"
SPLIT_DOCS = f"SELECT *, {SIDE} AS split FROM ({ranked('documents')})"



def first_line(value: str) -> str:
    return f"regexp_replace(string_split({value}, {LINE})[1], '^{WHITE}+', '')"


OUTPUTS = f"""
{PLACED}, said AS (
  SELECT conv_id, turn, question, answer, 'base' AS variant, {first_line('answer')} AS said FROM pairs
  UNION ALL
  SELECT conv_id, turn, question, answer, 'tuned', answer FROM pairs
), outputs AS (
  SELECT conv_id, turn, variant, conv_id % 4 AS task, answer AS expected,
         CASE turn % 3 WHEN 0 THEN {prompt('question')} || said || {text(chr(10) + '<|im_end|>')}
                       WHEN 1 THEN {prompt('question')} || said
                       ELSE said END AS output
  FROM said
), extracted AS (
  SELECT *, CASE
    WHEN regexp_matches(output, '(?s)<\\|im_start\\|>assistant\\n.+\\n<\\|im_end\\|>')
      THEN regexp_extract(output, '(?s)<\\|im_start\\|>assistant\\n(.+)\\n<\\|im_end\\|>', 1)
    WHEN regexp_matches(output, '(?s)<\\|im_start\\|>assistant\\n.+')
      THEN regexp_extract(output, '(?s)<\\|im_start\\|>assistant\\n(.+)', 1)
    ELSE output END AS part
  FROM outputs
), matched AS (
  SELECT *, CAST(part IS NOT DISTINCT FROM expected AS BIGINT) AS match FROM extracted
)
"""

COUNTED = """
counted AS (
  SELECT user_id, event_type, count(*) AS votes, min(event_id) AS first_pos
  FROM events GROUP BY user_id, event_type
), ranking AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, first_pos) AS rank,
         CAST(sum(votes) OVER (PARTITION BY user_id) AS BIGINT) AS n_votes
  FROM counted
)
"""

LATEST = """
WITH named AS (
  SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'runs'
    ELSE 'checkpoint-' || (o_orderkey % 1009) END AS name FROM orders
), numbered AS (
  SELECT *, CASE WHEN starts_with(name, 'checkpoint-')
    THEN CAST(string_split(name, '-')[2] AS BIGINT) END AS number FROM named
)
SELECT o_custkey, coalesce(arg_max(name, number), '') AS name,
       coalesce(max(number), -1) AS version
FROM numbered GROUP BY o_custkey
"""

BIGRAMS = f"""
listed AS (SELECT doc_id, lang, {tokens('text')} AS t FROM documents),
pairs AS (
  SELECT * FROM (SELECT doc_id, lang, unnest(t) AS token, unnest(list_prepend('', t)) AS prev FROM listed)
  WHERE token IS NOT NULL
),
experts AS (
  SELECT * FROM (VALUES {', '.join(f"('{e}', {i}, {COEFS[e]})" for i, e in enumerate(EXPERTS))})
    AS t(expert, expert_pos, coef)
),
counted AS (SELECT lang AS expert, prev, token, count(*) AS c FROM pairs GROUP BY ALL),
firsts AS (SELECT expert, prev, sum(c) AS n, count(*) AS f FROM counted GROUP BY ALL),
seconds AS (SELECT expert, token, count(*) AS b FROM counted GROUP BY ALL),
sizes AS (
  SELECT expert, sum(b) + (SELECT count(DISTINCT token) FROM pairs) AS size FROM seconds GROUP BY expert
),
per_doc AS (SELECT doc_id, prev, token, count(*) AS k FROM pairs GROUP BY ALL),
given AS (
  SELECT doc_id, k, expert, expert_pos, coef, coalesce(c, 0) AS c, n, f, (coalesce(b, 0) + 1) / size AS p
  FROM per_doc CROSS JOIN experts
  JOIN sizes USING (expert)
  LEFT JOIN counted USING (expert, prev, token)
  LEFT JOIN firsts USING (expert, prev)
  LEFT JOIN seconds USING (expert, token)
),
scores AS (
  SELECT doc_id, expert, expert_pos, coef, exp(-sum(k * ln(
           CASE WHEN n IS NULL THEN p ELSE greatest(c - 0.75, 0) / n + 0.75 * f / n * p END)) / sum(k)) AS ppl
  FROM given GROUP BY ALL
)
"""

UNIGRAMS = f"""
words AS (SELECT doc_id, lang, unnest({tokens('text')}) AS token FROM documents),
experts AS (
  SELECT * FROM (VALUES {', '.join(f"('{e}', {i}, {COEFS[e]})" for i, e in enumerate(EXPERTS))})
    AS t(expert, expert_pos, coef)
),
fitted AS (SELECT lang AS expert, token, count(*) AS c FROM words GROUP BY ALL),
size AS (SELECT count(DISTINCT token) AS v FROM words),
totals AS (SELECT expert, CAST(sum(c) AS BIGINT) AS n FROM fitted GROUP BY expert),
per_doc AS (SELECT doc_id, token, count(*) AS k FROM words GROUP BY ALL),
scores AS (
  SELECT doc_id, e.expert, e.expert_pos, e.coef,
         exp(-sum(k * ln((coalesce(c, 0) + 1) / (n + v))) / sum(k)) AS ppl
  FROM per_doc CROSS JOIN experts e CROSS JOIN size
  JOIN totals t ON t.expert = e.expert
  LEFT JOIN fitted f ON f.expert = e.expert AND f.token = per_doc.token
  GROUP BY ALL
)
"""

FANOUT = " UNION ALL ".join(
    [
        *[
            f"SELECT 'text-{lang}' AS recipe, doc_id, {pretrain('text')} AS text "
            f"FROM documents WHERE lang = '{lang}'"
            for lang in ("de", "en", "fr")
        ],
        f"SELECT 'source-en', doc_id, {training('source', text('Where is this from?'), 'text')} "
        "FROM documents WHERE lang = 'en'",
        "SELECT 'source-es', doc_id, "
        + training(
            "(CASE source WHEN 'src0' THEN 'books' WHEN 'src1' THEN 'news' ELSE source END)", "text"
        )
        + " FROM documents WHERE lang = 'es'",
    ]
)

WRITTEN = """
CASE doc_id % 6
  WHEN 0 THEN n_chars || 'KB'
  WHEN 1 THEN (n_chars // 10) || '.' || (n_chars % 10) || 'MB'
  WHEN 2 THEN (n_chars // 1000) || '.' || (n_chars % 10) || 'GB'
  WHEN 3 THEN (n_chars % 7) || '.' || (n_chars % 100) || 'TB'
  WHEN 4 THEN CAST(n_chars AS VARCHAR)
  ELSE 'Unknown' END
"""


def oracle_sql() -> dict[str, str]:
    hint, context_hint = text(HINT), text(CONTEXT_HINT)
    in_context = context_lines(context_hint, CONTEXT, "question")
    rendered = training("answer", "question")
    end = text("<|im_end|>\n")
    turn_text = glue(text("<|im_start|>"), "role", LINE, "text", end)
    running_on = glue("answer", text("\nUSER: "), "question", text("\nASSISTANT: \n"), "answer")
    labelled = f"SELECT doc_id, text, {QUALITY} AS label FROM documents JOIN labels USING (doc_id)"
    return {
        "training_summary": f"""
            SELECT split, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM (
              SELECT {SIDE} AS split, {pretrain('text')} AS text
              FROM ({ranked("(SELECT * FROM documents WHERE lang = 'en')")})
            ) GROUP BY split""",
        "training_labels": f"""
            SELECT doc_id, {training('label', 'text')} AS text, {SIDE} AS split
            FROM ({ranked(f'({labelled})')})""",
        "scan_dataset": "SELECT doc_id, lang, source, n_chars FROM documents",
        "split_slice": "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 10",
        "ingest_quarantine": """
            SELECT event_id,
                   CASE WHEN json_valid(raw) THEN CAST(raw ->> 'k' AS BIGINT) END AS k,
                   CASE WHEN NOT json_valid(raw) THEN raw END AS rejected
            FROM (SELECT event_id, CASE WHEN event_type = 'error'
                    THEN left(props, length(props) - 1) ELSE props END AS raw FROM events)""",
        "incremental_skip": """
            SELECT doc_id, lang, source, n_chars FROM documents d
            WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
        "incremental_filtered": """
            SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
        "recipe_fanout": FANOUT,
        "recipe_fanout_mixed": f"""
            SELECT 'mixed-en' AS recipe, doc_id, {pretrain('text')} AS text FROM documents WHERE lang = 'en'
            UNION ALL SELECT 'mixed-src', doc_id, {pretrain('text')} FROM documents WHERE source = 'src3'
            UNION ALL SELECT 'mixed-all', doc_id, {pretrain('text')} FROM documents""",
        "vote_ranking_nulls": """
            WITH given AS (
              SELECT CASE WHEN user_id % 5 <> 0 THEN user_id END AS user_id, event_type, event_id FROM events
            ), counted AS (
              SELECT user_id, event_type, count(*) AS votes, min(event_id) AS first_pos FROM given GROUP BY ALL
            )
            SELECT user_id, event_type, votes,
                   row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, first_pos) AS rank
            FROM counted""",
        "elapsed_nulls": """
            WITH given AS (
              SELECT event_id, CASE WHEN user_id % 3 <> 0 THEN user_id END AS user_id, ts FROM events
            )
            SELECT event_id, user_id, epoch_us(lead(ts) OVER w) - epoch_us(ts) AS elapsed_us
            FROM given WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
        "route_blank": f"""
            WITH blanked AS (
              SELECT doc_id, lang, CASE WHEN doc_id % 7 = 0 THEN '' ELSE text END AS text FROM documents
            ), {UNIGRAMS.replace('FROM documents', 'FROM blanked')}, chosen AS (
              SELECT doc_id, arg_min(expert, (ppl * coef, expert_pos)) AS expert,
                     round(min(ppl * coef), 4) AS score
              FROM scores GROUP BY doc_id
            )
            SELECT doc_id, expert, score FROM blanked LEFT JOIN chosen USING (doc_id)""",
        "map_rows_changed": "SELECT doc_id, upper(lang) AS lang, text FROM documents",
        "split_counts": f"SELECT split, lang, count(*) AS n_rows FROM ({SPLIT_DOCS}) GROUP BY split, lang",
        "filter_equals": "SELECT doc_id, lang, text FROM documents WHERE lang = 'de'",
        "filter_equals_int": "SELECT doc_id, quality, toxic FROM labels WHERE quality = 0",
        "systematic_sample": """
            SELECT doc_id, lang, text
            FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)
            WHERE idx % 3 = 0""",
        "systematic_sample_json": """
            SELECT doc_id, lang, text
            FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)
            WHERE idx % 3 = 0""",
        "slice_range": """
            SELECT doc_id, lang, text
            FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)
            WHERE idx >= 150 AND idx < 650""",
        "size_threshold": f"""
            SELECT source, CAST(sum(n_chars) AS BIGINT) AS total FROM documents
            GROUP BY source HAVING sum(n_chars) <= {SIZE_LIMIT}""",
        "label_map": f"SELECT doc_id, {QUALITY} AS label FROM labels",
        "line_normalize": f"SELECT doc_id, {normal('text')} AS text FROM documents",
        "render_pretrain": f"SELECT doc_id, {pretrain('text')} AS text FROM documents",
        "render_qa": pair_text(rendered),
        "render_hint": f"SELECT doc_id, {training('label', hint, 'text')} AS text FROM ({labelled})",
        "render_context": pair_text(training("answer", "question", CONTEXT)),
        "render_context_hint": pair_text(training("answer", *in_context)),
        "render_dispatch": f"""
            SELECT d.doc_id, CASE
                WHEN quality IS NULL THEN {pretrain('text')}
                WHEN lang = 'en' THEN
                  {training('CAST(quality AS VARCHAR)', *context_lines(context_hint, 'source', 'text'))}
                WHEN lang = 'de' THEN {training('CAST(quality AS VARCHAR)', 'text', 'source')}
                WHEN lang = 'es' THEN {training('CAST(quality AS VARCHAR)', hint, 'text')}
                ELSE {training('CAST(quality AS VARCHAR)', 'text')} END AS text
            FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
        "prompt_plain": asked_prompt(prompt("question")),
        "prompt_hint": asked_prompt(prompt(hint, "question")),
        "prompt_context": asked_prompt(prompt("question", CONTEXT)),
        "prompt_hint_context": asked_prompt(prompt(*in_context)),
        "prompt_dispatch": asked_prompt(
            f"""CASE
                WHEN prev_role = 'assistant' AND conv_id % 2 = 0
                  THEN {prompt(*context_lines(context_hint, 'prev_text', 'question'))}
                WHEN prev_role = 'assistant' THEN {prompt('question', 'prev_text')}
                WHEN prev_role = 'system' THEN {prompt('prev_text', 'question')}
                ELSE {prompt('question')} END"""
        ),
        "prompt_expert": asked_prompt(glue(LINE, prompt("question"))),
        "prompt_expert_context": asked_prompt(
            prompt(context_hint, glue(text("context:"), CONTEXT), glue(text("question:"), "question"))
        ),
        "prompt_translate": """
            SELECT item_id, '以下の英語を日本語に翻訳してください。翻訳結果のみを簡潔に出力してください。記号は全角にしてください。'
                   || chr(10) || text || chr(10) AS prompt FROM benchmark""",
        "chat_render": f"""
            SELECT conv_id, CAST(0 AS BIGINT) AS part, count(*) AS n_turns,
                   string_agg({turn_text}, '' ORDER BY turn)
                   || CASE WHEN arg_max(role, turn) = 'user'
                      THEN {text('<|im_start|>assistant' + chr(10))} ELSE '' END AS text
            FROM conversations GROUP BY conv_id""",
        "chat_format_inst": asked_prompt(
            glue(
                text("[INST] <<SYS>>"),
                "CASE WHEN prev_role = 'system' THEN prev_text ELSE '' END",
                text("<</SYS>>\n\n"),
                "question",
                text(" [/INST]\n"),
            )
        ),
        "chat_format_user_assistant": asked_prompt(
            glue(text("USER: "), "question", text("\nASSISTANT: \n"))
        ),
        "chat_format_ja": asked_prompt(glue(text("ユーザー: "), "question", text("\nシステム: \n"))),
        "stop_truncate": f"""
            WITH {PLACED} SELECT conv_id, turn,
              string_split_regex({running_on}, 'USER:|ASSISTANT:')[1] AS output FROM pairs""",
        "first_line": f"SELECT doc_id, {first_line('text')} AS line FROM documents",
        "parse_size": rf"""
            SELECT doc_id, size,
                   CASE WHEN unit IS NULL THEN NULL ELSE number * factor END AS size_bytes,
                   coalesce(unit = 'MB' OR (unit = 'GB' AND number <= 10), false) AS loadable,
                   coalesce(number * factor <= 1e10, false) AS fits
            FROM (
              SELECT doc_id, size, TRY_CAST(nullif(regexp_extract(size, '^([0-9.]+)[KMGT]B$', 1), '') AS DOUBLE) AS number,
                     nullif(regexp_extract(size, '^[0-9.]+([KMGT]B)$', 1), '') AS unit,
                     CASE right(size, 2) WHEN 'KB' THEN 1e3 WHEN 'MB' THEN 1e6 WHEN 'GB' THEN 1e9
                       WHEN 'TB' THEN 1e12 END AS factor
              FROM (SELECT doc_id, {WRITTEN} AS size FROM documents))""",
        "split_exact": f"SELECT doc_id, split FROM ({SPLIT_DOCS})",
        "split_hash": f"""
            SELECT doc_id, CASE WHEN CAST('0x' || substr({digest('doc_id')}, 1, 8) AS BIGINT) % 100 < 20
                   THEN 'test' ELSE 'train' END AS split FROM documents""",
        "eval_cap": f"SELECT doc_id, text FROM ({ranked('documents')}) WHERE place <= {SAMPLE_ROWS}",
        "truncate_tokens": f"""
            SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS text
            FROM (SELECT doc_id, ({tokens('text')})[1:{MAX_TOKENS}] AS t FROM documents)""",
        "pack_sequences": f"""
            WITH samples AS (
              SELECT doc_id, list_append({tokens('text')}, '<|endoftext|>') AS t FROM documents
            ), starts AS (
              SELECT *, sum(len(t)) OVER (ORDER BY {digest('doc_id')}) - len(t) AS start FROM samples
            ), flat AS (
              SELECT doc_id, unnest(t) AS token, start + generate_subscripts(t, 1) - 1 AS spot FROM starts
            )
            SELECT CAST(spot // {BLOCK} AS BIGINT) AS block_no, count(*) AS n_tokens,
                   count(DISTINCT doc_id) AS n_samples, string_agg(token, ' ' ORDER BY spot) AS text
            FROM flat GROUP BY 1""",
        "extract_user": f"""
            WITH {PLACED} SELECT conv_id, turn,
              nullif(regexp_extract({rendered}, '(?s)<\\|im_start\\|>user\\n(.+)\\n<\\|im_end\\|>', 1), '') AS part
            FROM pairs""",
        "extract_assistant": f"""
            WITH {PLACED} SELECT conv_id, turn,
              nullif(regexp_extract({rendered}, '(?s)<\\|im_start\\|>assistant\\n(.+)\\n<\\|im_end\\|>', 1), '') AS part
            FROM pairs""",
        "extract_robust": f"WITH {OUTPUTS} SELECT conv_id, turn, variant, part FROM matched",
        "exact_match_score": f"""
            WITH {OUTPUTS} SELECT variant, CAST(sum(match) AS BIGINT) AS score, count(*) AS n_items
            FROM matched GROUP BY variant""",
        "score_compare": f"""
            WITH {OUTPUTS} SELECT task,
              CAST(sum(match) FILTER (variant = 'base') AS BIGINT) AS base_score,
              CAST(sum(match) FILTER (variant = 'tuned') AS BIGINT) AS tuned_score,
              CAST(sum(CASE variant WHEN 'tuned' THEN match ELSE -match END) AS BIGINT) AS gain
            FROM matched GROUP BY task""",
        "vote_counts": f"WITH {COUNTED} SELECT user_id, event_type, votes, first_pos FROM counted",
        "vote_consensus": f"WITH {COUNTED} SELECT user_id, event_type, votes, n_votes FROM ranking WHERE rank = 1",
        "vote_ranking": f"WITH {COUNTED} SELECT user_id, event_type, votes, rank FROM ranking",
        "perplexity_tokens": "SELECT user_id, round(exp(avg(value / 100)), 4) AS ppl FROM events GROUP BY user_id",
        "perplexity_unigram": f"WITH {UNIGRAMS} SELECT doc_id, expert, round(ppl, 4) AS ppl FROM scores",
        "expert_route": f"""
            WITH {UNIGRAMS} SELECT doc_id, arg_min(expert, (ppl * coef, expert_pos)) AS expert,
                   round(min(ppl * coef), 4) AS score
            FROM scores GROUP BY doc_id""",
        "perplexity_bigram": f"WITH {BIGRAMS} SELECT doc_id, expert, round(ppl, 4) AS ppl FROM scores",
        "expert_route_bigram": f"""
            WITH {BIGRAMS} SELECT doc_id, arg_min(expert, (ppl * coef, expert_pos)) AS expert,
                   round(min(ppl * coef), 4) AS score
            FROM scores GROUP BY doc_id""",
        "vote_counts_stream": """
            SELECT user_id, event_type, count(*) AS votes, min(event_id) AS first_pos FROM events GROUP BY ALL""",
        "latest_version_stream": LATEST,
        "latest_version": LATEST,
        "elapsed": """
            SELECT event_id, user_id, epoch_us(lead(ts) OVER w) - epoch_us(ts) AS elapsed_us
            FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
        "map_rows": "SELECT doc_id, lang, text FROM documents",
        "map_rows_isolated": f"""
            SELECT doc_id,
                   CASE WHEN length(text) <= {WINDOW_CHARS}
                     THEN length(regexp_replace(text, '[^a-z]', '', 'g')) END AS n_lower,
                   CASE WHEN length(text) > {WINDOW_CHARS} THEN 'ValueError: text longer than the window' END AS error
            FROM documents""",
    }

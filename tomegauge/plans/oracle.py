"""The same answers in SQL for DuckDB, written from the definitions, word by word."""

import re
from types import SimpleNamespace

from tomegauge.plans import catalog

# Fixed values, written out here once more so that a slip in the engine shows: the published formulae and BM25.
K1, B = 1.2, 0.75
grades = SimpleNamespace(
    SMOG_FACTOR=1.043, SMOG_OFFSET=3.1291,
    EASE_OFFSET=206.835, EASE_PER_WORD=1.015, EASE_PER_SYLLABLE=84.6,
    GRADE_PER_WORD=0.39, GRADE_PER_SYLLABLE=11.8, GRADE_OFFSET=15.59,
    CHALL_PER_PERCENT=0.1579, CHALL_PER_WORD=0.0496, CHALL_ADJUSTMENT=3.6365,
)


def query_terms(phrase: str, unicode: bool = False) -> list[str]:
    return sorted(set(re.findall(r"\w+" if unicode else r"[a-z0-9_]+", phrase.lower())))

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _round(value: str, digits: int) -> str:
    """Half up on the decimal digits of a double; ``round`` on the double itself scales it first and so errs on ties."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def _runs(word: str) -> str:
    return (
        f"(len(regexp_extract_all({word}, '[aeiouy]+')) - CASE WHEN length({word}) > 2 AND suffix({word}, 'es') THEN 1 "
        f"WHEN length({word}) > 1 AND suffix({word}, 'e') THEN 1 ELSE 0 END)"
    )


def _flag(word: str, least: int = 2) -> str:
    return f"CASE WHEN {_runs(word)} >= {least} THEN 1 ELSE 0 END"


def _sum_over(words: str, expression: str) -> str:
    return f"CAST(coalesce(list_sum(list_transform({words}, lambda w: {expression})), 0) AS INTEGER)"


def _tokens(sentence: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({sentence}), '\\W'), lambda w: length(w) > 0)"


def _unicode_tokens(sentence: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({sentence}), '[^\\p{{L}}\\p{{N}}_]+'), lambda w: length(w) > 0)"


def _cut(source: str, name: str, text: str = "rawDocument") -> str:
    marked = rf"""regexp_replace({text}, '([.!?]+["'')\]]*)\s+', '\1' || chr(1), 'g')"""
    return f"""
    {name}_cut AS (
      SELECT fileName, list_filter(list_transform(str_split({marked}, chr(1)),
             lambda s: trim(s, {_SPACE})), lambda s: length(s) > 0) AS parts FROM {source}),
    {name}_pieces AS (
      SELECT fileName, CAST(unnest(range(len(parts))) AS INTEGER) AS position, unnest(parts) AS sentenceText,
             CAST(len(parts) AS INTEGER) AS numSentencesInBook FROM {name}_cut)"""


def _facts(source: str, name: str, least: int = 2) -> str:
    """CTEs up to a sentence table ``name`` with its token array ``words``."""
    return f"""{_cut(source, name)},
    {name}_words AS (SELECT *, {_tokens('sentenceText')} AS words FROM {name}_pieces),
    {name} AS (
      SELECT fileName, position, sentenceText, numSentencesInBook,
             {_sum_over('words', _flag('w', least))} AS multiSyllableCount,
             CAST(len(words) AS INTEGER) AS numWordsInSentence, words FROM {name}_words)"""


_BOOKS = """
    books AS (SELECT 'txt/' || doc_id || '.txt' AS fileName, replace(text, chr(10), ' ') AS rawDocument,
              doc_id, lang, source FROM documents)"""
_TURNS = """
    turns AS (SELECT 'chat/' || conv_id || '/' || turn || '.txt' AS fileName,
              replace(text, chr(10), ' ') AS rawDocument FROM conversations)"""
_FACTS = f"WITH {_BOOKS}, {_facts('books', 'facts')}"

_COLUMNS = "fileName, position, sentenceText, numSentencesInBook, multiSyllableCount, numWordsInSentence"

# Literals with an exponent are DOUBLE in DuckDB, plain decimals are not.
_SMOG = _round(f"{grades.SMOG_FACTOR}e0 * sqrt(30 * m / n) + {grades.SMOG_OFFSET}e0", 2)

_TOTALS = f"""{_FACTS},
    totals AS (SELECT fileName, count(*) AS n, CAST(sum(multiSyllableCount) AS BIGINT) AS m FROM facts GROUP BY 1),
    scored AS (SELECT fileName, n AS doc_count, m AS sum_multiSyllables, {_SMOG} AS smog FROM totals)"""

_BLOCKS = f"""{_FACTS},
    block_totals AS (SELECT fileName, CAST(position // 30 AS BIGINT) AS block, count(*) AS n,
        CAST(sum(multiSyllableCount) AS BIGINT) AS m FROM facts GROUP BY 1, 2),
    blocks AS (SELECT fileName, block, n AS doc_count, m AS sum_multiSyllables, {_SMOG} AS smog
        FROM block_totals WHERE n = 30)"""

_TOKENS = f"""{_FACTS},
    tokens AS (SELECT fileName, position, unnest(words) AS word FROM facts)"""

_EASY = f"""easy AS (SELECT DISTINCT unnest({_tokens('text')}) AS word FROM benchmark)"""

_EASE = _round(
    f"{grades.EASE_OFFSET}e0 - {grades.EASE_PER_WORD}e0 * (w / n)"
    f" - {grades.EASE_PER_SYLLABLE}e0 * (syl / nullif(w, 0))",
    2,
)
_GRADE = _round(
    f"{grades.GRADE_PER_WORD}e0 * (w / n) + {grades.GRADE_PER_SYLLABLE}e0 * (syl / nullif(w, 0))"
    f" - {grades.GRADE_OFFSET}e0",
    2,
)
_CHALL = _round(
    f"{grades.CHALL_PER_PERCENT}e0 * pct + {grades.CHALL_PER_WORD}e0 * (w / n)"
    f" + CASE WHEN pct > 5 THEN {grades.CHALL_ADJUSTMENT}e0 ELSE 0e0 END",
    2,
)

_FORMULAE = f"""{_TOKENS}, {_EASY},
    hard AS (SELECT fileName, count(*) AS difficult FROM tokens ANTI JOIN easy USING (word) GROUP BY 1),
    counted AS (SELECT fileName, count(*) AS n, CAST(sum(multiSyllableCount) AS BIGINT) AS m,
        CAST(sum(numWordsInSentence) AS BIGINT) AS w,
        CAST(sum({_sum_over('words', f"greatest(1, {_runs('w')})")}) AS BIGINT) AS syl FROM facts GROUP BY 1),
    measured AS (SELECT *, coalesce(difficult, 0) AS d, 100 * coalesce(difficult, 0) / nullif(w, 0) AS pct
        FROM counted LEFT JOIN hard USING (fileName)),
    formulae AS (SELECT fileName, n, w, syl, d, {_SMOG} AS smog, {_EASE} AS reading_ease,
        {_GRADE} AS flesch_grade, {_CHALL} AS dale_chall FROM measured)"""

_FORMS = """
    corpus_words AS (SELECT DISTINCT word AS form FROM tokens),
    forms AS (SELECT form, left(form, length(form) - cut) AS lemma FROM (
        SELECT form, CASE WHEN suffix(form, 'ing') THEN 3 WHEN suffix(form, 'ed') THEN 2
                          WHEN suffix(form, 's') THEN 1 ELSE 0 END AS cut FROM corpus_words)
        WHERE cut > 0 AND length(form) > cut)"""

_POLARITY = (
    f"CASE WHEN lemma IN ({_list(catalog.POSITIVE)}) THEN 1 ELSE 0 END"
    f" - CASE WHEN lemma IN ({_list(catalog.NEGATIVE)}) THEN 1 ELSE 0 END"
)

_LABELLED = f"""WITH words AS (
    SELECT DISTINCT word, label FROM (
      SELECT unnest({_unicode_tokens('text')}) AS word, 'negative' AS label
        FROM documents JOIN labels USING (doc_id) WHERE toxic = 1
      UNION ALL
      SELECT unnest({_unicode_tokens('text')}) AS word, 'positive' AS label
        FROM documents JOIN labels USING (doc_id) WHERE quality = 1))
    SELECT word, label FROM words"""

_RELOADED = f"""WITH {_BOOKS}, {_TURNS}, {_facts('books', 'facts')},
    flagged AS (SELECT books.* FROM books SEMI JOIN (SELECT doc_id FROM labels WHERE toxic = 1) USING (doc_id)),
    {_facts('flagged', 'again', 3)}, {_facts('turns', 'chats')}
    SELECT {_COLUMNS} FROM facts ANTI JOIN flagged USING (fileName)
    UNION ALL SELECT {_COLUMNS} FROM again
    UNION ALL SELECT {_COLUMNS} FROM chats"""

_BY_NAME = f"""{_FACTS}, named AS (SELECT {_COLUMNS} FROM facts
    WHERE list_contains(regexp_split_to_array(lower(fileName), '\\W+'), '10')
)"""


def _json(columns: str, key: str = "") -> str:
    fields = [f"'sentence_id': {key}"] if key else []
    return "to_json({" + ", ".join(fields + [f"'{c}': {c}" for c in columns.split(", ")]) + "})"


def _bm25(phrase: str, unicode: bool, limit: int = 20) -> str:
    terms = query_terms(phrase, unicode)
    cut = _unicode_tokens if unicode else _tokens
    gain = "ln(1e0 + (docs - df + 0.5e0) / (df + 0.5e0)) * tf"
    score = f"sum({gain} / (tf + {K1}e0 * (1e0 - {B}e0 + {B}e0 * len(w) / mean)) ORDER BY term)"
    return f"""{_FACTS},
    sized AS (SELECT fileName, position, multiSyllableCount, sentenceText, {cut('sentenceText')} AS w FROM facts),
    corpus AS (SELECT count(*) AS docs, avg(len(w)) AS mean FROM sized),
    hits AS (SELECT fileName, position, term, count(*) AS tf FROM
        (SELECT fileName, position, unnest(w) AS term FROM sized) WHERE term IN ({_list(terms)}) GROUP BY 1, 2, 3),
    df AS (SELECT term, count(*) AS df FROM hits GROUP BY 1),
    ranked AS (SELECT fileName, position, {score} AS score
      FROM hits JOIN df USING (term) JOIN sized USING (fileName, position), corpus GROUP BY 1, 2)
    SELECT fileName, position, multiSyllableCount, sentenceText, {_round('score', 4)} AS score,
      (SELECT count(*) FROM ranked) AS total
    FROM ranked JOIN sized USING (fileName, position) ORDER BY ranked.score DESC, fileName, position LIMIT {limit}"""


def _replace(levels: int, least: int = 1) -> str:
    sign, flag = ("m - goal", 1) if levels < 0 else ("goal - m", 0)
    grade = f"{grades.SMOG_FACTOR}e0 * sqrt(30 * m / n) + {grades.SMOG_OFFSET}e0 + ({levels}e0)"
    root = f"(greatest(({grade}) - {grades.SMOG_OFFSET}e0, 0e0) / {grades.SMOG_FACTOR}e0)"
    return f"""{_TOKENS},
    totals AS (SELECT fileName, count(*) AS n, CAST(sum(multiSyllableCount) AS BIGINT) AS m FROM facts GROUP BY 1),
    goals AS (SELECT fileName, m, n / 30 * ({root} * {root}) AS goal FROM totals WHERE n >= {least}),
    needs AS (SELECT fileName, CAST(ceil({sign}) AS BIGINT) AS needed FROM goals),
    counted AS (SELECT fileName, word, count(*) AS occurrences FROM tokens WHERE {_flag('word')} = {flag} GROUP BY 1, 2),
    listed AS (SELECT *, CAST(coalesce(sum(occurrences) OVER (PARTITION BY fileName ORDER BY occurrences DESC, word
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM counted)
    SELECT fileName, word, occurrences, before, needed FROM listed JOIN needs USING (fileName) WHERE before < needed"""


def _genre(column: str, genre: str, low: float, high: float, limit: str) -> str:
    return f"""{_TOTALS}
    SELECT fileName, doc_count, sum_multiSyllables, smog, {column} AS genre FROM scored JOIN books USING (fileName)
    WHERE {column} = '{genre}' AND smog BETWEEN {low} AND {high} {limit}"""


# After a reload with texts cut to 200 characters.
_SHORTENED = f"""WITH {_BOOKS}, {_facts('books', 'facts')},
            flagged AS (SELECT fileName, left(rawDocument, 200) AS rawDocument
              FROM books SEMI JOIN (SELECT doc_id FROM labels WHERE toxic = 1) USING (doc_id)),
            {_facts('flagged', 'again')},
            shortened AS (SELECT {_COLUMNS} FROM facts ANTI JOIN flagged USING (fileName)
              UNION ALL SELECT {_COLUMNS} FROM again)"""


def _shortened_passage(first: int, last: int, also: str = "") -> str:
    return f"""{_SHORTENED},
            totals AS (SELECT fileName, count(*) AS n, CAST(sum(multiSyllableCount) AS BIGINT) AS m FROM shortened
              WHERE position BETWEEN {first} AND {last} {also} GROUP BY 1)
            SELECT fileName, n AS doc_count, m AS sum_multiSyllables, {_SMOG} AS smog FROM totals"""


def oracle_sql() -> dict[str, str]:
    key = "fileName || '#' || position"
    test_path, test_text = catalog.TEST_BOOK
    test_text = "' || chr(10) || chr(13) || '".join(test_text.split("\n\r"))
    guarded = r"regexp_replace(rawDocument, '\b(of|the|la)\.(\s)', '\1' || chr(2) || '\2', 'g')"
    return {
        "newline_cleaning": f"WITH {_BOOKS} SELECT fileName, rawDocument FROM books",
        "book_collection": f"""
            WITH raw AS (SELECT '{test_path}' AS filepath, '{test_text}' AS t
              UNION ALL SELECT 'corpus/txt/' || doc_id || '.txt', text FROM documents)
            SELECT filepath, regexp_extract(filepath, '[^/]*$') AS fileName,
                   replace(replace(t, chr(10), ' '), chr(13), ' ') AS rawDocument FROM raw""",
        "base_names": "SELECT page_id, regexp_extract(url, '[^/]*$') AS name FROM pages",
        "sentence_segmentation": f"""{_FACTS}
            SELECT fileName, position, sentenceText, numSentencesInBook FROM facts""",
        "guarded_segmentation": f"""
            WITH {_TURNS}, {_cut('turns', 'guarded', guarded)}
            SELECT fileName, position, replace(sentenceText, chr(2), '.') AS sentenceText, numSentencesInBook
            FROM guarded_pieces""",
        "tokenization": f"""{_FACTS}
            SELECT fileName, position, array_to_string(words, ' ') AS words, numWordsInSentence FROM facts""",
        "unicode_tokenization": f"""{_FACTS}
            SELECT fileName, position, array_to_string({_unicode_tokens('sentenceText')}, ' ') AS words FROM facts""",
        "word_syllables": f"""{_TOKENS}
            SELECT word, count(*) AS occurrences, CAST(greatest(1, {_runs('word')}) AS INTEGER) AS syllables,
                   CAST({_flag('word')} AS INTEGER) AS flag FROM tokens GROUP BY word""",
        "raw_sentence_flags": f"""{_FACTS}
            SELECT fileName, position, array_to_string(list_transform(str_split(sentenceText, ' '),
                     lambda w: {_flag('w')}), ' ') AS flags,
                   {_sum_over("str_split(sentenceText, ' ')", _flag('w'))} AS multiSyllableCount FROM facts""",
        "token_array_counts": f"""{_FACTS}
            SELECT fileName, position, {_sum_over('words', _flag('w', 2))} AS from_two,
                   {_sum_over('words', _flag('w', 3))} AS from_three FROM facts""",
        "sentence_counts_from_three": f"""
            WITH {_BOOKS}, {_facts('books', 'facts', 3)} SELECT {_COLUMNS} FROM facts""",
        "sentence_table": f"{_FACTS} SELECT {_COLUMNS} FROM facts",
        "conversation_sentence_table": f"WITH {_TURNS}, {_facts('turns', 'chats')} SELECT {_COLUMNS} FROM chats",
        "sentence_table_by_stages": f"{_FACTS} SELECT {_COLUMNS} FROM facts",
        "sentence_keys": f"{_FACTS} SELECT {key} AS sentence_id, fileName, position FROM facts",
        "index_documents": f"""{_FACTS}
            SELECT {key} AS sentence_id, CAST({_json(_COLUMNS, key)} AS VARCHAR) AS value FROM facts""",
        "json_sentences_by_name": f"{_BY_NAME} SELECT CAST({_json(_COLUMNS)} AS VARCHAR) AS value FROM named",
        "sentences_by_name": f"{_BY_NAME} SELECT {_COLUMNS} FROM named",
        "sentences_by_name_terms": f"""{_FACTS} SELECT {_COLUMNS} FROM facts
            WHERE list_has_any(regexp_split_to_array(lower(fileName), '\\W+'), ['txt', '10'])""",
        "sentences_of_book": f"{_FACTS} SELECT {_COLUMNS} FROM facts WHERE fileName = '{catalog.BOOK}'",
        "first_sentences": f"{_FACTS} SELECT {_COLUMNS} FROM facts ORDER BY fileName, position LIMIT 10000",
        "first_hundred_sentences": f"{_FACTS} SELECT {_COLUMNS} FROM facts ORDER BY fileName, position LIMIT 100",
        "corpus_preview": f"""WITH {_BOOKS}
            SELECT fileName, left(rawDocument, 150) AS preview FROM books ORDER BY fileName LIMIT 5""",
        "differing_documents": """
            SELECT doc_id, lang, NULL::VARCHAR AS genre, NULL::INTEGER AS quality FROM documents
            UNION ALL SELECT doc_id, NULL, source, NULL FROM documents
            UNION ALL SELECT doc_id, NULL, NULL, quality FROM labels""",
        "sentence_counts": f"{_FACTS} SELECT fileName, count(*) AS doc_count FROM facts GROUP BY 1",
        "corpus_totals": f"""{_FACTS}
            SELECT CAST(sum(multiSyllableCount) AS BIGINT) AS sum_multiSyllables, count(*) AS sentenceCount FROM facts""",
        "book_totals": f"{_TOTALS} SELECT fileName, doc_count, sum_multiSyllables FROM scored",
        "book_scores": f"{_TOTALS} SELECT * FROM scored",
        "book_scores_from_thirty": f"{_TOTALS} SELECT * FROM scored WHERE doc_count >= 30",
        "book_scores_from_texts": f"{_TOTALS} SELECT * FROM scored",
        "score_buckets": f"""{_TOTALS},
            kept AS (SELECT * FROM scored ORDER BY doc_count DESC, fileName LIMIT 10)
            SELECT *, CAST((SELECT sum(doc_count) FROM scored) - (SELECT sum(doc_count) FROM kept) AS BIGINT)
                   AS sum_other_doc_count FROM kept""",
        "books_in_range": f"""{_TOTALS}
            SELECT *, CAST(0 AS BIGINT) AS sum_other_doc_count FROM scored
            WHERE smog >= {catalog.LOW} AND smog <= {catalog.HIGH}""",
        "books_in_range_of_largest": f"""{_TOTALS},
            kept AS (SELECT * FROM scored ORDER BY doc_count DESC, fileName LIMIT 10)
            SELECT *, CAST((SELECT sum(doc_count) FROM scored) - (SELECT sum(doc_count) FROM kept) AS BIGINT)
                   AS sum_other_doc_count FROM kept WHERE smog >= {catalog.LOW} AND smog <= 15.9""",
        "score_of_book": f"{_TOTALS} SELECT * FROM scored WHERE fileName = '{catalog.BOOK}'",
        "score_of_passage": f"""{_FACTS},
            totals AS (SELECT fileName, count(*) AS n, CAST(sum(multiSyllableCount) AS BIGINT) AS m FROM facts
              WHERE fileName = '{catalog.BOOK}' AND position BETWEEN 2 AND 9 GROUP BY 1)
            SELECT fileName, n AS doc_count, m AS sum_multiSyllables, {_SMOG} AS smog FROM totals""",
        "passage_scores": f"""{_FACTS},
            totals AS (SELECT fileName, count(*) AS n, CAST(sum(multiSyllableCount) AS BIGINT) AS m FROM facts
              WHERE position BETWEEN {catalog.FIRST} AND {catalog.LAST} GROUP BY 1)
            SELECT fileName, n AS doc_count, m AS sum_multiSyllables, {_SMOG} AS smog FROM totals""",
        "block_scores": f"{_BLOCKS} SELECT * FROM blocks",
        "block_distribution": f"""{_BLOCKS}
            SELECT fileName, count(*) AS blocks, min(smog) AS min_smog,
                   {_round('quantile_cont(smog, 0.25)', 4)} AS q1_smog, {_round('quantile_cont(smog, 0.5)', 4)} AS median_smog,
                   {_round('quantile_cont(smog, 0.75)', 4)} AS q3_smog, max(smog) AS max_smog FROM blocks GROUP BY 1""",
        "genre_quantiles": f"""{_BLOCKS}, graded AS (SELECT source AS genre, smog FROM blocks JOIN books USING (fileName)),
            asked AS (SELECT unnest([0.05e0, 0.25e0, 0.5e0, 0.75e0, 0.95e0]) AS quantile),
            placed AS (SELECT genre, smog, row_number() OVER (PARTITION BY genre ORDER BY smog) AS place,
              count(*) OVER (PARTITION BY genre) AS blocks FROM graded)
            SELECT genre, CAST(blocks AS BIGINT) AS blocks, quantile, min(smog) AS smog FROM placed, asked
            WHERE place >= quantile * blocks GROUP BY 1, 2, 3""",
        # Every beginning of the last segment is tried at every block; nothing is left out.
        "change_points": f"""{_BLOCKS.replace('WITH', 'WITH RECURSIVE', 1)},
            series AS (SELECT fileName, list(smog ORDER BY block) AS g FROM blocks GROUP BY 1),
            summed AS (SELECT fileName, g, list_transform(range(0, len(g) + 1), lambda k: coalesce(list_sum(g[1:k]), 0e0)) AS s,
              list_transform(range(0, len(g) + 1), lambda k: coalesce(list_sum(list_transform(g[1:k], lambda x: x * x)), 0e0)) AS q FROM series),
            best(fileName, t, costs, froms) AS (
              SELECT fileName, 0, [0e0], [CAST(0 AS BIGINT)] FROM summed
              UNION ALL
              SELECT fileName, t, list_append(costs, list_min(tried)), list_append(froms, CAST(list_position(tried, list_min(tried)) - 1 AS BIGINT))
              FROM (SELECT b.fileName, b.t + 1 AS t, costs, froms,
                  list_transform(range(0, b.t + 1), lambda k: round(costs[k + 1] + ((q[b.t + 2] - q[k + 1])
                    - (s[b.t + 2] - s[k + 1]) * (s[b.t + 2] - s[k + 1]) / CAST(b.t + 1 - k AS DOUBLE)) + 12e0, 6)) AS tried
                FROM best b JOIN summed USING (fileName) WHERE b.t < len(g))),
            done AS (SELECT fileName, g, froms FROM best JOIN summed USING (fileName) WHERE t = len(g)),
            walked(fileName, a, b) AS (
              SELECT fileName, froms[len(g) + 1], CAST(len(g) AS BIGINT) FROM done
              UNION ALL
              SELECT w.fileName, froms[a + 1], a FROM walked w JOIN done USING (fileName) WHERE a > 0)
            SELECT fileName, CAST(row_number() OVER (PARTITION BY fileName ORDER BY a) - 1 AS INTEGER) AS segment, CAST(a AS INTEGER) AS first_block,
              CAST(b - 1 AS INTEGER) AS last_block, {_round('list_sum(g[a + 1:b]) / (b - a)', 2)} AS mean_smog FROM walked JOIN done USING (fileName)""",
        "learned_abbreviations": f"""WITH {_BOOKS},
            words AS (SELECT w FROM (SELECT unnest(regexp_split_to_array(lower(rawDocument), '\\s+')) AS w FROM books)
              WHERE regexp_full_match(w, '[a-z]+(\\.[a-z]+)*\\.?')),
            counts AS (SELECT rtrim(w, '.') AS word, count(*) FILTER (WHERE suffix(w, '.')) AS with_stop,
              count(*) FILTER (WHERE NOT suffix(w, '.')) AS without_stop FROM words GROUP BY 1),
            totals AS (SELECT CAST(sum(with_stop) AS DOUBLE) / sum(with_stop + without_stop) AS share FROM counts),
            scored AS (SELECT word, with_stop, without_stop, length(replace(word, '.', '')) AS letters,
              2e0 * ((with_stop * ln(0.99e0) + without_stop * ln(1e0 - 0.99e0)) - (with_stop * ln(share) + without_stop * ln(1e0 - share))) AS ratio,
              FROM counts, totals WHERE with_stop > 0)
            SELECT word, with_stop, without_stop, {_round("ratio * exp(-letters) * (length(word) - letters + 1) * pow(letters, -without_stop)", 4)} AS score
            FROM scored WHERE {_round("ratio * exp(-letters) * (length(word) - letters + 1) * pow(letters, -without_stop)", 4)} >= 0.3""",
        "block_histogram": f"""{_BLOCKS}
            SELECT fileName, CAST(floor(smog) AS BIGINT) AS grade, count(*) AS blocks FROM blocks GROUP BY 1, 2""",
        "rolling_scores": f"""{_FACTS},
            framed AS (SELECT fileName, position, count(*) OVER f AS n,
                CAST(sum(multiSyllableCount) OVER f AS BIGINT) AS m FROM facts
                WINDOW f AS (PARTITION BY fileName ORDER BY position ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
            SELECT fileName, position, m AS passage_multiSyllables, {_SMOG} AS smog FROM framed WHERE n = 30""",
        "block_changes": f"""{_BLOCKS}, lagged AS (
            SELECT fileName, block, smog, lag(smog) OVER (PARTITION BY fileName ORDER BY block) AS previous_smog FROM blocks)
            SELECT *, {_round('smog - previous_smog', 2)} AS change FROM lagged""",
        "book_trends": f"""{_BLOCKS}
            SELECT fileName, count(*) AS blocks, {_round('regr_slope(smog, CAST(block AS DOUBLE))', 4)} AS slope
            FROM blocks GROUP BY 1 HAVING count(*) > 1""",
        "books_of_genre": _genre("source", catalog.GENRE, 5, 15, "ORDER BY smog DESC, fileName LIMIT 20"),
        "books_of_language": _genre("lang", "fr", 3, 30, ""),
        "books_without_theme": f"""{_TOTALS},
            flagged AS (SELECT 'txt/' || doc_id || '.txt' AS fileName FROM labels WHERE toxic = 1)
            SELECT scored.* FROM scored ANTI JOIN flagged USING (fileName) WHERE smog BETWEEN 3 AND 400""",
        "flesch_scores": f"""{_FORMULAE}
            SELECT fileName, n AS doc_count, w AS words, syl AS syllables, reading_ease, flesch_grade FROM formulae""",
        "dale_chall_scores": f"""{_FORMULAE}
            SELECT fileName, n AS doc_count, w AS words, d AS difficult, dale_chall FROM formulae""",
        "formulae_compared": f"""{_FORMULAE}
            SELECT fileName, smog, reading_ease, flesch_grade, dale_chall,
                   {_round('smog - flesch_grade', 2)} AS smog_minus_flesch FROM formulae""",
        "formula_ranks": f"""{_FORMULAE},
            long AS (SELECT fileName, 'smog' AS formula, smog AS score FROM formulae
              UNION ALL SELECT fileName, 'flesch_grade', flesch_grade FROM formulae
              UNION ALL SELECT fileName, 'dale_chall', dale_chall FROM formulae)
            SELECT fileName, formula, score, rank() OVER (PARTITION BY formula ORDER BY score DESC) AS rank
            FROM long WHERE score IS NOT NULL""",
        "formula_correlations": f"""{_FORMULAE}
            SELECT count(*) AS books, {_round('corr(smog, flesch_grade)', 4)} AS smog_flesch,
                   {_round('corr(smog, dale_chall)', 4)} AS smog_dale_chall,
                   {_round('corr(flesch_grade, dale_chall)', 4)} AS flesch_dale_chall FROM formulae""",
        "words_to_lower": _replace(-2),
        "words_to_lower_from_thirty": _replace(-2, 30),
        "words_to_raise": _replace(2),
        "charged_share": f"""{_FACTS},
            marked AS (SELECT fileName, CASE WHEN list_has_any(words, [{_list(catalog.CHARGED)}]) THEN 1 ELSE 0 END AS hit
              FROM facts)
            SELECT fileName, count(*) AS doc_count, CAST(sum(hit) AS BIGINT) AS charged_sentences,
                   {_round('avg(hit)', 4)} AS charged_share FROM marked GROUP BY 1""",
        "any_term": f"""{_FACTS}
            SELECT {_COLUMNS} FROM facts WHERE list_has_any(words, [{_list(query_terms(catalog.PHRASE))}])""",
        "phrase_search": _bm25(catalog.PHRASE, False),
        "phrase_search_unicode": _bm25(catalog.UNICODE_PHRASE, True),
        "phrase_search_by_index": _bm25(catalog.PHRASE, False),
        "phrase_search_with_rare_term": _bm25(catalog.RARE_PHRASE, False, 5),
        "frequent_term_search": _bm25("the", False, 5),
        "postings": f"""{_FACTS}
            SELECT term, fileName, position, length, count(*) AS tf FROM
              (SELECT fileName, position, CAST(len(words) AS INTEGER) AS length, unnest(words) AS term FROM facts)
            GROUP BY 1, 2, 3, 4""",
        "lemma_counts": f"""{_TOKENS}, {_FORMS}
            SELECT word, coalesce(lemma, word) AS lemma, count(*) AS occurrences
            FROM tokens LEFT JOIN forms ON word = form GROUP BY 1, 2""",
        "labelled_lemmas": f"""{_TOKENS}
            SELECT word AS lemma, CAST({_POLARITY.replace('lemma', 'word')} AS INTEGER) AS polarity,
                   count(*) AS occurrences FROM tokens GROUP BY 1, 2""",
        "sentence_sentiment": f"""{_TOKENS}, {_FORMS},
            lemmatized AS (SELECT fileName, position, coalesce(lemma, word) AS lemma
              FROM tokens LEFT JOIN forms ON word = form),
            polar AS (SELECT fileName, position, sum({_POLARITY}) AS s FROM lemmatized GROUP BY 1, 2),
            summed AS (SELECT fileName, position, CAST(coalesce(s, 0) AS BIGINT) AS score
              FROM facts LEFT JOIN polar USING (fileName, position))
            SELECT *, CASE WHEN score > 0 THEN 'positive' WHEN score < 0 THEN 'negative' ELSE 'neutral' END AS sentiment
            FROM summed""",
        # A text file ends in one line feed more than the text it was written from.
        "listed_files": "SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS length FROM documents",
        "first_files": """SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS length FROM documents
            ORDER BY 'doc_id=' || doc_id || '/' LIMIT 25""",
        "read_files": "SELECT doc_id, replace(text, chr(10), ' ') || ' ' AS rawDocument FROM documents",
        "read_first_files": """SELECT doc_id, replace(text, chr(10), ' ') || ' ' AS rawDocument FROM documents
            ORDER BY 'doc_id=' || doc_id || '/' LIMIT 25""",
        "file_contents": """SELECT md5(text || chr(10)) AS digest, CAST(strlen(text) + 1 AS INTEGER) AS length
            FROM documents""",
        "loaded_books": f"""{_FACTS} SELECT doc_id, {_COLUMNS.replace('fileName, ', '')}
            FROM facts JOIN books USING (fileName)""",
        "word_lists": _LABELLED,
        "stored_lexicon": _LABELLED,
        "stored_lemmas": f"{_TOKENS}, {_FORMS} SELECT form, lemma FROM forms",
        "stored_sentences": f"{_FACTS} SELECT {_COLUMNS} FROM facts",
        "stored_book": f"{_FACTS} SELECT {_COLUMNS} FROM facts WHERE fileName = '{catalog.BOOK}'",
        "stored_json_documents": f"{_FACTS} SELECT {key} AS sentence_id, {_COLUMNS} FROM facts",
        "upserted_sentences": _RELOADED,
        "reloaded_sentences": _RELOADED,
        "reloaded_shorter_books": f"{_SHORTENED} SELECT {_COLUMNS} FROM shortened",
        "loaded_by_manifest": f"""{_FACTS} SELECT doc_id, {_COLUMNS.replace('fileName, ', '')}
            FROM facts JOIN books USING (fileName)""",
        "loaded_in_chunks": f"""{_FACTS} SELECT doc_id, {_COLUMNS.replace('fileName, ', '')}
            FROM facts JOIN books USING (fileName)""",
        "chunked_segmentation": f"{_FACTS} SELECT {_COLUMNS} FROM facts",
        "manifest_files": """SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS length,
            CAST(CASE WHEN row_number() OVER (ORDER BY 'doc_id=' || doc_id || '/') <= 25 THEN 1 ELSE 2 END AS BIGINT) AS load
            FROM documents""",
        "totals_of_loads": f"""{_FACTS} SELECT doc_id, count(*) AS doc_count,
            CAST(sum(multiSyllableCount) AS BIGINT) AS sum_multiSyllables, CAST(sum(numWordsInSentence) AS BIGINT) AS words
            FROM facts JOIN books USING (fileName) GROUP BY 1""",
        "maintained_totals": f"""{_SHORTENED} SELECT fileName, count(*) AS doc_count,
            CAST(sum(multiSyllableCount) AS BIGINT) AS sum_multiSyllables, CAST(sum(numWordsInSentence) AS BIGINT) AS words
            FROM shortened GROUP BY 1""",
        "kept_books_in_range": f"""{_SHORTENED}, totals AS (SELECT fileName, count(*) AS n,
              CAST(sum(multiSyllableCount) AS BIGINT) AS m FROM shortened GROUP BY 1),
            scored AS (SELECT fileName, n AS doc_count, m AS sum_multiSyllables, {_SMOG} AS smog FROM totals)
            SELECT * FROM scored WHERE smog BETWEEN {catalog.LOW} AND {catalog.HIGH}""",
        "stored_passage_by_running": _shortened_passage(2, 37, f"AND fileName = '{catalog.BOOK}'"),
        "passage_scores_by_running": _shortened_passage(catalog.FIRST, catalog.LAST),
        "reset_then_loaded": f"WITH {_TURNS}, {_facts('turns', 'chats')} SELECT {_COLUMNS} FROM chats",
        "created_with_repeats": f"{_FACTS} SELECT {_COLUMNS} FROM facts",
        "loaded_in_three": f"""{_FACTS} SELECT doc_id, {_COLUMNS.replace('fileName, ', '')}
            FROM facts JOIN books USING (fileName)""",
        "stored_book_score": f"{_TOTALS} SELECT * FROM scored WHERE fileName = '{catalog.BOOK}'",
        "stored_passage_score": f"""{_FACTS},
            totals AS (SELECT fileName, count(*) AS n, CAST(sum(multiSyllableCount) AS BIGINT) AS m FROM facts
              WHERE fileName = '{catalog.BOOK}' AND position BETWEEN 2 AND 9 GROUP BY 1)
            SELECT fileName, n AS doc_count, m AS sum_multiSyllables, {_SMOG} AS smog FROM totals""",
        "reloaded_documents": """
            SELECT doc_id, CAST(CASE WHEN quality IS NULL THEN to_json({'doc_id': doc_id, 'lang': lang, 'source': source})
                   ELSE to_json({'doc_id': doc_id, 'quality': quality, 'toxic': toxic}) END AS VARCHAR) AS value
            FROM documents LEFT JOIN labels USING (doc_id)""",
        "stored_lines": f"{_FACTS} SELECT sentenceText FROM facts",
        "stored_response": f"{_BY_NAME} SELECT {_COLUMNS} FROM named",
        "reset_table": f"WITH {_TURNS}, {_facts('turns', 'chats')} SELECT {_COLUMNS} FROM chats",
    }

"""DuckDB spellings of the T1-T5 text expressions for the oracle queries."""

from probity.functions.text import DROPPED_CHARS, WHITESPACE_RUN


def normalize_sql(x: str) -> str:
    """T1 on column/expression ``x``."""
    return ("trim(regexp_replace(regexp_replace(lower(" + x + "), '" + WHITESPACE_RUN
            + "', ' ', 'g'), '" + DROPPED_CHARS + "', '', 'g'))")


def words_sql(x: str) -> str:
    return "list_filter(string_split(" + normalize_sql(x) + ", ' '), lambda w: w <> '')"


def chunks_sql(w: str, digits: int = 8) -> str:
    """md5 prefixes of the 10-word chunks of word list ``w`` (in order)."""
    n = "CAST(ceil(len(" + w + ") / 10) AS BIGINT)"
    return ("list_transform(range(0, " + n + "), lambda i: substr(md5(array_to_string("
            + w + "[i * 10 + 1 : i * 10 + 10], ' ')), 1, " + str(digits) + "))")


def tokens_sql(id_col: str, text: str, src: str) -> str:
    """Rows (id, toks): sorted distinct whole-text chunk hashes of non-empty texts."""
    return ("SELECT id, list_sort(list_distinct(" + chunks_sql("words", 32) + ")) AS toks "
            "FROM (SELECT " + id_col + " AS id, " + words_sql(text) + " AS words FROM " + src
            + ") w WHERE len(words) > 0")

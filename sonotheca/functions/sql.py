"""The text functions under their names in SQL, as temporary functions with native bodies.

After ``register_functions(spark)`` a query may say

    SELECT t.file, c.chunk_ix, c.document FROM transcripts t, LATERAL chunk_text(t.text) c

Spark inlines the bodies, so nothing runs in Python and Catalyst sees through them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from sonotheca.fixed_values import CHUNK_OVERLAP, CHUNK_SIZE, NEWER_LETTERS, OTHER_DIGITS, SENTENCE_BREAK
from sonotheca.functions.text import _FOLD_BLOCK, _SPACE


def _text(value: str) -> str:
    """A raw SQL string."""
    return f"r'{value}'"


_SENTENCES = f"split(text, {_text(SENTENCE_BREAK)}, -1)"
_TITLE = _text(rf"(?s)(?=[^\p{{L}}\p{{Nd}} ])(?![{OTHER_DIGITS}{NEWER_LETTERS}]).")

# The fold of ``chunk_ranges``: the open chunk is its first sentence, the lengths it holds and
# their sum.  A sentence that would push the sum over the size closes it; the next one begins with
# the longest tail that stays below the overlap.
_TAIL = """aggregate(reverse(acc.held), named_struct('n', 0, 'chars', 0, 'open', true),
  (t, x) -> if(t.open AND t.chars + x < overlap, named_struct('n', t.n + 1, 'chars', t.chars + x, 'open', true),
               named_struct('n', t.n, 'chars', t.chars, 'open', false)))"""
_STEP = f"""if(size(acc.held) > 0 AND acc.chars + len > chunk_size,
  transform(array({_TAIL}), tail -> named_struct(
    'done', concat(acc.done, array(named_struct('first', acc.first, 'n', size(acc.held)))),
    'first', acc.first + size(acc.held) - tail.n,
    'held', concat(slice(acc.held, size(acc.held) - tail.n + 1, tail.n), array(len)), 'chars', tail.chars + len))[0],
  named_struct('done', acc.done, 'first', acc.first, 'held', concat(acc.held, array(len)), 'chars', acc.chars + len))"""
_RANGES = f"""aggregate(
  transform(sequence(1, size(lens), {_FOLD_BLOCK}), i -> slice(lens, i, {_FOLD_BLOCK})),
  named_struct('done', cast(array() AS ARRAY<STRUCT<first: INT, n: INT>>), 'first', 0, 'held', cast(array() AS ARRAY<INT>), 'chars', 0),
  (whole, block) -> transform(array(aggregate(block,
      named_struct('done', cast(array() AS ARRAY<STRUCT<first: INT, n: INT>>), 'first', whole.first, 'held', whole.held, 'chars', whole.chars),
      (acc, len) -> {_STEP})),
    b -> named_struct('done', concat(whole.done, b.done), 'first', b.first, 'held', b.held, 'chars', b.chars))[0],
  whole -> concat(whole.done, array(named_struct('first', whole.first, 'n', size(whole.held)))))"""
_CHUNKS = f"""transform(array(if(text RLIKE {_text(f'(?U)[^{_SPACE}]')}, {_SENTENCES}, cast(array() AS ARRAY<STRING>))), s -> if(size(s) = 0, cast(array() AS ARRAY<STRING>),
  transform(transform(array(transform(s, x -> length(x))), lens -> {_RANGES})[0], r -> array_join(slice(s, r.first + 1, r.n), ' '))))[0]"""

FUNCTIONS = {
    "split_sentences": f"(text STRING) RETURNS ARRAY<STRING> RETURN {_SENTENCES}",
    "safe_title": f"(title STRING) RETURNS STRING RETURN rtrim(regexp_replace(title, {_TITLE}, ''))",
    "chunk_id": "(filename STRING, chunk_ix INT) RETURNS STRING "
                "RETURN concat(replace(replace(filename, ' ', '_'), '.txt', ''), '_', chunk_ix)",
    "chunk_text": f"(text STRING, chunk_size INT DEFAULT {CHUNK_SIZE}, overlap INT DEFAULT {CHUNK_OVERLAP}) "
                  f"RETURNS TABLE (chunk_ix INT, document STRING) RETURN SELECT posexplode({_CHUNKS})",
    "sentence_rows": f"(text STRING) RETURNS TABLE (sentence_ix INT, sentence STRING) RETURN SELECT posexplode({_SENTENCES})",
}


def register_functions(spark: SparkSession) -> None:
    """Make the functions known to the session; a blank or null text has no chunks."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")

"""Declared table layouts (nothing is inferred at read time)."""

from pyspark.sql import types as T

_str = T.StringType()
_words = T.ArrayType(_str)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RAW_PAIRS = _table(row_id=T.LongType(), query=_str, response=_str,
                   category=_str, intent=_str, flags=_str)

PREPARED_PAIRS = _table(row_id=T.LongType(), query_clean=_str, response_clean=_str,
                        query_tokens=_words, response_tokens=_words,
                        category=_str, intent=_str, split=_str)

HYPOTHESES = _table(query_id=T.LongType(), strategy=_str, hyp_id=T.IntegerType(),
                    token_ids=T.ArrayType(T.IntegerType()),
                    logprob_sum=T.DoubleType(), len=T.IntegerType())

TOKEN_LOGPROBS = _table(query_id=T.LongType(), pos=T.IntegerType(),
                        token_id=T.IntegerType(), logprob=T.DoubleType())

"""Schemas of the dictionary tables."""

from __future__ import annotations

from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


S = T.StringType()
PRONUNCIATION = _struct(ipa=S, audio=S, label=S)
ETYMOLOGY = _struct(raw=S, segments=T.ArrayType(_struct(form=S, description=S)))
EXAMPLE = _struct(text=S, source=S)
DEFINITION = _struct(number=S, definition=S, grammar=S, see_also=STRINGS, related=STRINGS, examples=T.ArrayType(EXAMPLE))
DETAIL = _struct(type=S, text=S, source=S, items=STRINGS)
EXPRESSION = _struct(expression=S, details=T.ArrayType(DETAIL))
ENTRY = _struct(
    file=S,
    headword=S,
    pos=S,
    udtale=T.ArrayType(PRONUNCIATION),
    wordforms=STRINGS,
    etymology=ETYMOLOGY,
    definitions=T.ArrayType(DEFINITION),
    fixed_expressions=T.ArrayType(EXPRESSION),
    orddannelser=T.MapType(S, STRINGS),
)
WORD_LIST = _struct(rank=T.IntegerType(), word=S)
AUDIO_MAP = _struct(url=S, path=S)
POS_TRANSLATIONS = _struct(pos=S, pos_tr=S)
DEFINITION_TRANSLATIONS = _struct(headword=S, definition=S, lemma=S, gloss=S)
EXPRESSION_TRANSLATIONS = _struct(headword=S, expression=S, lemma=S, gloss=S)
PROGRESS = _struct(headword=S, kind=S, status=S, n_items=T.IntegerType())
FETCHED = _struct(key=S, content=T.BinaryType(), error=S)

#: The fields of a card, in order.
NOTE_FIELDS = ["Headword", "POS", "IPA", "Definition", "Grammar", "Example", "Variants", "Collocations", "Derivatives", "Etymology", "FrequencyRank"]
#: The fields of a plain card: all but the rank.
PLAIN_FIELDS = NOTE_FIELDS[:-1]

"""Declared schemas of the main tables."""

from pyspark.sql import types as T

S, L, I, D, B, X = T.StringType(), T.LongType(), T.IntegerType(), T.DateType(), T.BooleanType(), T.DoubleType()


def _struct(**kinds) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


MEMBER = _struct(bioguide=S, name=S, party=S, state=S, chamber=S)
RAW_RECORD = _struct(url=S, title=S, text=S, date=S, collected_at=S, date_source=S, member=_struct(bioguide_id=S, name=S, party=S, state=S, chamber=S), _corrupt_record=S)
STATEMENT = _struct(id=S, lane=I, url=S, title=S, text=S, published_at=D, bioguide=S, name=S, party=S, state=S, chamber=S, congress=I, joint_group=S, syndicated=B)
LEDGER_PHRASE = _struct(ngram=S, n=I, first_day=D, first_bioguide=S, ties=T.ArrayType(S), df_share=X, df_weight=X, peak_units=L, total_uses=L, distinct_units=L)
LEDGER_DAILY = _struct(ngram=S, day=D, party=S, units=L, families=L)
OFFICE_INTERVAL = _struct(bioguide=S, start=D, end_exclusive=D, party=S, chamber=S, voting_status=S)
ATTESTATION = _struct(bioguide=S, start=D, end_exclusive=D, state=S)

"""Table schemas, declared once and never inferred."""

from pyspark.sql import types as T

_S, _D, _TS = T.StringType(), T.DoubleType(), T.TimestampType()
_MAP = T.MapType(_S, _S)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


#: A landed record; ``raw`` is the payload as JSON text.
BRONZE = _struct(source=_S, record_id=_S, published_at=_TS, retrieved_at=_TS, raw=_S)
TEXT = _struct(record_id=_S, source=_S, source_type=_S, title=_S, text=_S, published_at=_TS, retrieved_at=_TS, url=_S, region=_S, categories=T.ArrayType(_S), dimensions=_MAP, metadata=_S)
NUMERIC = _struct(record_id=_S, source=_S, observed_at=_TS, variable=_S, value=_D, retrieved_at=_TS, region=_S, unit=_S, dimensions=_MAP, metadata=_S)
FORECAST = _struct(forecast_id=_S, model_name=_S, model_version=_S, target=_S, forecast_origin_utc=_TS, forecast_for_utc=_TS, forecast_for_local=T.TimestampNTZType(), horizon=T.IntegerType(), value=_D, generated_at_utc=_TS)
MODEL = _struct(model_name=_S, version=_S, trained_at=_TS, target=_S, features=T.ArrayType(_S), coefficients=T.ArrayType(_D), intercept=_D, metrics=T.MapType(_S, _D))

# Fixed column names of the tab-separated knowledge-graph files, in file order.
GKG_COLUMNS = (
    "GKGRECORDID DATE SourceCollectionIdentifier SourceCommonName DocumentIdentifier Counts V2Counts Themes V2Themes Locations V2Locations Persons V2Persons Organizations V2Organizations "
    "Tone Dates GCAM SharingImage RelatedImages SocialImageEmbeds SocialVideoEmbeds Quotations AllNames Amounts TranslationInfo Extras"
).split()
GKG = T.StructType([T.StructField(c, _S) for c in GKG_COLUMNS])
REGION_ROW = T.StructType([T.StructField(c, _S) for c in ("period", "respondent", "respondent-name", "type", "type-name", "value", "value-units")])
INTERCHANGE_ROW = T.StructType([T.StructField(c, _S) for c in ("period", "fromba", "fromba-name", "toba", "toba-name", "value", "value-units")])

"""Table schemas, enumerations and their ranks."""

from __future__ import annotations

from pyspark.sql import types as T

CERTAINTY = ("unresolved", "inferred", "explicit")  # weakest first
SALIENCE = ("reference", "supporting", "primary")
SOURCE_KINDS = ("epub", "markdown", "text")
ATTRIBUTE_TYPES = ("string", "number", "boolean", "string-list", "entity-ref", "object")
SEVERITY = ("error", "warning", "review")
STATUS = ("pass", "fail", "warning")

_S = T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _list(kind: T.DataType = _S) -> T.ArrayType:
    return T.ArrayType(kind)


PROVENANCE = _struct(sourceId=_S, segmentId=_S, segmentOrdinal=T.IntegerType(), locator=_S, excerpt=_S)
SOURCES = _struct(id=_S, path=_S, kind=_S, sha256=_S, title=_S, segmentCount=T.IntegerType())
SEGMENTS = _struct(id=_S, sourceId=_S, ordinal=T.IntegerType(), title=_S, text=_S, sha256=_S, locator=_S)
CLAIM = _struct(text=_S, certainty=_S, excerpt=_S)
ENTITY = _struct(name=_S, category=_S, aliases=_list(), summary=_S, salience=_S, certainty=_S, excerpt=_S, attributes=T.VariantType(), claims=_list(CLAIM))
RELATIONSHIP = _struct(subject=_S, predicate=_S, object=_S, certainty=_S, excerpt=_S)
PASSAGE = _struct(title=_S, kind=_S, speaker=_S, text=_S, context=_S, significance=_S, entities=_list(), complete=T.BooleanType(), certainty=_S)
EXTRACTIONS = _struct(segmentId=_S, summary=_S, plotBeats=_list(), themes=_list(), entities=_list(ENTITY), relationships=_list(RELATIONSHIP), passages=_list(PASSAGE), openQuestions=_list())
ENTITIES = _struct(id=_S, category=_S, canonicalName=_S, aliases=_list(), summary=_S, salience=_S, certainty=_S, firstSeen=PROVENANCE, mentions=_list(PROVENANCE), attributes=T.MapType(_S, T.VariantType()))
CLAIMS = _struct(id=_S, entityId=_S, text=_S, certainty=_S, provenance=PROVENANCE)
RELATIONSHIPS = _struct(id=_S, subjectId=_S, predicate=_S, objectId=_S, literalObject=_S, certainty=_S, provenance=PROVENANCE)
PASSAGES = _struct(id=_S, title=_S, kind=_S, speakerId=_S, text=_S, context=_S, significance=_S, entityIds=_list(), complete=T.BooleanType(), certainty=_S, provenance=PROVENANCE)
QUESTIONS = _struct(id=_S, text=_S, provenance=PROVENANCE)
MERGES = _struct(canonicalEntityId=_S, mergedName=_S, reason=_S, automatic=T.BooleanType())
ISSUES = _struct(id=_S, severity=_S, code=_S, message=_S, segmentId=_S, entityId=_S)
GATES = _struct(id=_S, status=_S, message=_S, details=_list())
PAGES = _struct(path=_S, content=_S)

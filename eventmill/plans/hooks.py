"""Registered queries of what a caller brings: cleaners and serializers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from eventmill.functions.jsontext import structured_fields
from eventmill.operators import delivery
from eventmill.plans.queries import batched_events, query
from eventmill.sources import views


@query
def clean_rejected_documents(spark, folder):
    """Rejected documents through a caller's cleaner of row, status and error, ready to be sent again."""
    events = batched_events(spark, folder)
    answers = delivery.parsed(views.bulk_responses(events))
    failed = delivery.failures_by_id(events.select("batch_id", "pos", "event_id", "action", "doc"), answers)

    def cleaner(row, status, error):
        number = F.regexp_replace(row, r'"k":"s(\d+)"', r'"k":$1')
        return F.when((status == 400) & error.contains("mapper_parsing"), number).otherwise(F.concat(row, F.lit(" ")))

    return delivery.cleaned(failed, cleaner).select("batch_id", "pos", "event_id", "status", "doc")


@query
def custom_serializers(spark, folder):
    """A caller's serializer of one property, in Arrow batches; where it gives nothing the usual text stays."""
    @F.pandas_udf("string")
    def masked(users: pd.Series) -> pd.Series:
        return ('"user-' + users.astype("string") + '"').where(users % 2 == 0, None)

    logs = views.log_events(spark, folder)
    fields = structured_fields(logs, ["event_type", "user_id"], {"user_id": masked})
    return logs.select("event_id", fields["event_type"].alias("event_type"), fields["user_id"].alias("user"))

"""Answer reports as they arrive, one run per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from caseweave.operators.tfidf import case_index
from caseweave.plans.run import answered_run
from caseweave.workspace import Scope, scope, written

RESULTS, UNANSWERED = "results", "unanswered"


class _AtTheEnd(StreamingQueryListener):
    """Closes a scope when its query has ended."""

    def __init__(self, own: Scope):
        self.own, self.query_id = own, None

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == str(self.query_id):
            self.own.close()


def answer_reports(
    reports: DataFrame,
    kb: DataFrame,
    folder: str,
    checkpoint: str,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Start a query that writes the run results of each micro-batch below ``folder``.

    ``results`` gets the answered reports and ``unanswered`` those that could not be searched
    for, with the reason; the batch goes on without them. The words of the cases are counted
    once. A batch that is repeated after a failure overwrites its own folders, so every report
    is answered once. The intermediate tables of a batch go when it is written, those of the
    cases when the query ends. ``options`` go to ``answered_run``.
    """
    spark = reports.sparkSession
    whole = Scope(spark)
    with whole.use():
        index = case_index(kb)

    def answer(batch: DataFrame, batch_id: int) -> None:
        with scope(batch.sparkSession):
            run = answered_run(written(batch, "batch"), kb, index=index, **options)
            unanswered = written(run.unanswered, "unanswered")
            unanswered.write.mode("overwrite").parquet(f"{folder}/{UNANSWERED}/batch={batch_id}")
            run.results.write.mode("overwrite").parquet(f"{folder}/{RESULTS}/batch={batch_id}")

    listener = _AtTheEnd(whole)
    spark.streams.addListener(listener)
    query = (
        reports.writeStream.foreachBatch(answer)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    listener.query_id = query.id
    if not query.isActive:
        whole.close()
    return query

"""Trigger for the refresh jobs: new files in an input folder, instead of a request.

The figures cover whole tables, so an arrival only says that a refresh is due; the refresh itself reads the batch
inputs. The merge is idempotent, so a batch that is run again after a failure changes nothing.
"""

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..session import shared_folder
from ..sources import Table, read_all


def refresh_on_arrival(
    arrivals: DataFrame,
    tables: Mapping[str, Table],
    refresh: Callable[[dict[str, DataFrame]], object],
    name: str,
    once: bool = False,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Call `refresh` with the inputs of `tables` for every micro-batch of the streaming frame `arrivals` that holds rows.

    The inputs are read anew each time, as a frame keeps the list of files it was made with. A refresh scans whole
    tables: let `interval` be long enough for that. With `once` the query handles what has arrived and stops. Progress is
    kept under the shared folder.
    """

    def due(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            refresh(read_all(batch.sparkSession, tables))

    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (
        arrivals.writeStream.queryName(name)
        .option("checkpointLocation", f"{shared_folder(arrivals.sparkSession)}/arrivals/{name}")
        .trigger(**trigger)
        .foreachBatch(due)
        .start()
    )

"""Early stopping on a stream of epoch losses: the same answer as ``operators.history.early_stops``, while training runs.

The state of a run is one row (epochs seen, best epoch and loss, epochs since, the epoch that it stopped at), so it stays small however
long the run is. Epochs of a run come in ascending order over the stream's batches, in any order inside one; an epoch
at or before the last one seen is a repeated delivery and changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE = "epochs long, seen long, best_epoch long, best_loss double, since long, stop_epoch long"
OUT = "run string, best_epoch long, best_loss double, stop_epoch long, epochs long"


class EarlyStop(StatefulProcessor):
    def __init__(self, patience: int) -> None:
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("run", STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        epochs, seen, best_epoch, best_loss, since, stop = self.state.get() if self.state.exists() else (0, None, None, None, 0, None)
        arrived = pd.concat(rows).sort_values(["epoch", "loss"])
        for epoch, loss in zip(arrived["epoch"].tolist(), arrived["loss"].tolist(), strict=True):
            if stop is not None or seen is not None and epoch <= seen:
                continue
            epochs, seen = epochs + 1, epoch
            if loss == loss and loss is not None and (best_loss is None or loss < best_loss):
                best_epoch, best_loss, since = epoch, loss, 0
            else:
                since += 1
            if since >= self.patience:
                stop = epoch
        self.state.update((epochs, seen, best_epoch, best_loss, since, stop))
        row = pd.DataFrame({"run": [key[0]], "best_epoch": [best_epoch], "best_loss": [best_loss], "stop_epoch": [stop], "epochs": [epochs]})
        yield row.astype({"best_epoch": "Int64", "stop_epoch": "Int64", "best_loss": "float64"})

    def close(self) -> None:
        pass


def stopping(history: DataFrame, patience: int) -> DataFrame:
    """Of every batch, the runs that it touched as they stand now. ``history`` streams (run, epoch, loss); its session keeps state in RocksDB."""
    return history.groupBy("run").transformWithStateInPandas(EarlyStop(patience), OUT, "update", "none")

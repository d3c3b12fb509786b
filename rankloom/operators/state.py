"""Fitted stages whose state is a table: saved as Parquet beside the parameters, joined when applied."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class TableModel(Model, MLWritable, MLReadable):
    """A model with named state tables. Subclasses add parameters and ``_transform``."""

    def __init__(self):
        super().__init__()
        self.tables: dict[str, DataFrame] = {}

    def with_tables(self, **tables: DataFrame):
        self.tables = tables
        return self

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class _TableWriter(MLWriter):
    def __init__(self, model: TableModel):
        super().__init__()
        self._model = model

    def saveImpl(self, path: str) -> None:
        names = sorted(self._model.tables)
        DefaultParamsWriter.saveMetadata(self._model, path, self.sparkSession, extraMetadata={"tables": names})
        for name in names:
            self._model.tables[name].write.parquet(f"{path}/tables/{name}")


class _TableReader(MLReader):
    def __init__(self, cls: type[TableModel]):
        super().__init__()
        self._cls = cls

    def load(self, path: str) -> TableModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self._cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        read = self.sparkSession.read.parquet
        return model.with_tables(**{n: read(f"{path}/tables/{n}") for n in metadata["tables"]})


def join_state(df: DataFrame, state: DataFrame, keys: list[str], value: str) -> tuple[DataFrame, Column]:
    """Left-join one state column under a private name; Catalyst chooses the strategy from the table's known size."""
    hidden = f"_state_{value}"
    out = df.join(state.select(*keys, F.col(value).alias(hidden)), keys, "left").select(*df.columns, hidden)
    return out, F.col(hidden)

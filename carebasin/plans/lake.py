"""Tables to the lake, in the folders of their layout, with few bytes shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebasin import schemas
from carebasin.functions import columns as fx
from carebasin.operators.documents import of_type
from carebasin.sources.writers import well_dealt, write_table


def write_clean(name: str, df: DataFrame, path: str, source: DataFrame | None = None, folders: int | None = None) -> None:
    """Write a clean table in its partition folders.

    ``source`` is what its rows are read from one by one. Where the tasks that read it have enough
    for a file of their own in each of the ``folders`` (counted unless they are known),
    they write them and no row is shuffled. Otherwise rows are gathered by folder, and their
    surrogate keys, which hardly compress, are computed after that.
    """
    _, partition_by = {**schemas.CLAIMS_LAKE, **schemas.CLINICAL_LAKE}[name]
    key, business = schemas.SURROGATES[name]
    if source is not None and well_dealt(source):
        folders = folders or df.select(*partition_by).distinct().count()
        if well_dealt(source, folders):
            write_table(df, path, partition_by, rebalance=False)
            return
    write_table(df, path, partition_by, late={key: fx.sha_key(F.col(business))} if business in df.columns else None)


def write_clinical(name: str, df: DataFrame, path: str, resources: DataFrame) -> None:
    """Write a clinical table that was built from staged ``resources``."""
    kind = schemas.ROW_BY_ROW.get(name)
    write_clean(name, df, path, of_type(resources, kind) if kind else None, schemas.FEW_FOLDERS)

"""Landed candle pages as a stream into the bar store: each batch of new files becomes one layer, once."""

import json

from barworks.functions.schema import KEYS, VALUES
from barworks.sources import candles, store

PAGES = "pair string, timeframe string, page_no long, candles string"


def _stream_id(spark, checkpoint):
    """The lasting id of the stream that owns a checkpoint folder; a new folder makes a new stream that starts at batch 0."""
    fs, _, path = store._fs(spark, checkpoint)
    stream = fs.open(path(f"{checkpoint}/metadata"))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())["id"]
    finally:
        stream.close()


def pages_to_store(spark, landing, root, checkpoint, refused=None, partition_by=KEYS, schema=PAGES, **options):
    """Start a query that appends the bars of all pages landing as Parquet files under `landing` to the store at `root`.

    It takes what is there and ends; with the same checkpoint it goes on from there. A batch that ran before but was not
    acknowledged runs again and changes nothing: the commit of its layer names stream and batch. Bars that are stored stay as
    they are. Pages that give no bars are written to `refused`, a folder per stream and batch, if one is named.
    `options` go to the file source, as maxFilesPerTrigger does.
    """
    def land(pages, number):
        stream = _stream_id(spark, checkpoint)
        bars = candles.combine_pages(pages).select(*KEYS, "timestamp", *VALUES)
        store.write_bars(bars, root, partition_by, batch=(stream, number))
        if refused:
            candles.refused_pages(pages).write.mode("overwrite").parquet(f"{refused}/stream={stream}/batch={number}")

    source = spark.readStream.schema(schema).options(**options).parquet(landing)
    return source.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

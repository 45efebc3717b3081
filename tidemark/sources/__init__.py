from .extract import change_filter, high_water_mark, incremental_extract, window_stats
from .relational import catalog_reader, frame_reader, jdbc_reader, parquet_reader
from .watermark import read_watermark, watermark_history, write_watermark

__all__ = ["catalog_reader", "change_filter", "frame_reader", "high_water_mark",
           "incremental_extract", "jdbc_reader", "parquet_reader", "read_watermark",
           "watermark_history", "window_stats", "write_watermark"]

from medalake.functions.expressions import (any_differs, any_null, epoch_ms_to_ts,
                                            file_date, normalized_load_type,
                                            stamp_name, to_day, ts_literal,
                                            ts_to_epoch_ms)

__all__ = ["any_differs", "any_null", "epoch_ms_to_ts", "file_date", "normalized_load_type",
           "stamp_name", "to_day", "ts_literal", "ts_to_epoch_ms"]

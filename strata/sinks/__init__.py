from strata.sinks.files import (date_parts, envelopes, json_arrays, land_csv, read_back, write_envelopes,
                                write_json_arrays, write_landing, write_layer, write_report)

__all__ = ["date_parts", "envelopes", "json_arrays", "land_csv", "read_back", "write_envelopes",
           "write_json_arrays", "write_landing", "write_layer", "write_report"]

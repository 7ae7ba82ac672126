from vigil.sources.readings import (  # noqa: F401
    READINGS_SCHEMA,
    read_readings,
    read_snapshot,
    read_csv_snapshot,
    write_snapshot,
    write_parquet,
    split_by_device,
    frame_from_rows,
    preview,
    repartition_by_device,
    load_table,
    events_as_readings,
    EVENT_METRICS,
    EVENT_ROLES,
)

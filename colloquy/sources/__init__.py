"""Sources: parquet test tables, labelled/history CSV, single texts, Kafka options."""

from colloquy.sources.tables import (  # noqa: F401
    assemble_dialogues,
    labelled_documents,
    read_table,
)
from colloquy.sources.files import (  # noqa: F401
    LABELLED_SCHEMA,
    read_history,
    read_labelled,
    require_columns,
    single_text,
    upload_summary,
    write_predictions_csv,
)
from colloquy.sources.kafka import kafka_reader_options, kafka_writer_options, read_kafka_stream  # noqa: F401

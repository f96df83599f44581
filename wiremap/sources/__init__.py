from wiremap.sources.tables import read_table  # noqa: F401
from wiremap.sources.files import (  # noqa: F401
    add_file_provenance, file_date_sent, file_hostname, raw_stream,
)

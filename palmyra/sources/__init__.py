from palmyra.sources.tables import (  # noqa: F401
    RENAMES,
    SCHEMAS,
    WAREHOUSE_NAMES,
    conform,
    load,
    load_jdbc,
    positional,
)
from palmyra.sources.writers import (  # noqa: F401
    clear_stages,
    cut_lineage,
    export_csv,
    publish,
    read_csv,
    read_current,
    scratch_path,
    shared_dir,
    vacuum,
)

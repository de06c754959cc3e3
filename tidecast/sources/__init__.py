from tidecast.sources.io import (  # noqa: F401
    chart_table,
    clean_bars,
    load_model,
    read_bars,
    save_model,
    write_bars,
    write_predictions,
)
from tidecast.sources.tables import events_ticks, lineitem_ticks, orders_ticks, table  # noqa: F401

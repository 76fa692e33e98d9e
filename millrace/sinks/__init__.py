"""Writers: result tables, dated exports, keyed snapshots."""

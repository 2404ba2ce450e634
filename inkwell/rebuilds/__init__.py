"""Late-arriving data. The event export comes in daily batches that keep changing for
some days, so a run rebuilds a window of days; there are no continuous streams."""

"""DataFrame -> DataFrame building blocks. None of them collects rows to the driver."""

"""DataFrame-to-DataFrame operators. None of them runs a Spark job by itself unless it says so."""

"""Record steps, routing, keyed processing, running values, metrics and sinks."""

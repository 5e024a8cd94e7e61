"""Tables, message streams and sinks."""

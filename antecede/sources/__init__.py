"""Sources and sinks: landing files, the exactly-once load, seeds, web pages."""

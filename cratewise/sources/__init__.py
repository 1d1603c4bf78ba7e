"""Sources, sinks and the stage area."""

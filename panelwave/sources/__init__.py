"""Reading period files, writing stages, and deciding what must be re-read."""

"""The phases of a panel study, each a function from frames to lazy frames."""

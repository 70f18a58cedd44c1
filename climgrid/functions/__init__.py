"""Column builders: calendar, units, humidity, radiation, freeze/thaw, projection."""

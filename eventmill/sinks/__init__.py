"""Tables, loads, layouts and text exports."""

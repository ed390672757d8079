"""Where data comes from: landed pages, the calendar, high-water marks, tables."""

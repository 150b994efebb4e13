"""The warehouse run on generic order and event tables instead of trip records."""
